"""Ledger views and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from partflow.catalogue.entries import Tables, day, event_partitions, query
from partflow.functions.keys import day_text
from partflow.operators import ledger, reports

# Events as a ledger of their partition (type, day): each is the record of an
# upload, of which the larger ones did not complete, and of an error, of its
# upload if it is very large and else of its validation.
_LEDGER_SQL = """
led as (select event_type x, strftime(ts, '%Y-%m-%d') p, event_id i, value v, user_id u from events),
uploads as (select x, p, i, v, u from (select *, row_number() over (partition by x, p order by i desc, v desc) r
  from led) where r = 1)
"""


def _uploads(t: Tables):
    status = F.when(F.col("value") <= 107, "completed").otherwise("failed")
    records = event_partitions(t)
    return ledger.current_uploads(
        records.select(
            "exporter",
            "partition_value",
            "event_seq",
            "value",
            F.col("user_id").alias("file_size"),
            F.col("event_seq").alias("uploaded_at"),
            status.alias("status"),
        )
    )


@query(f"""
with {_LEDGER_SQL}
select x as exporter, p as partition_value, i as event_seq, u as file_size, case when v <= 107 then 'completed' else 'failed' end as status from uploads
""")
def ledger_current(t: Tables):
    return _uploads(t).select("exporter", "partition_value", "event_seq", "file_size", "status")


@query(f"""
with {_LEDGER_SQL}
select distinct x as exporter, p as partition_value from led
where not exists (select 1 from uploads w where w.x = led.x and w.p = led.p and w.v <= 107)
""")
def failed_partitions(t: Tables):
    events = event_partitions(t)
    validation = events.where("value <= 200")
    return ledger.failed_partitions(events.where("value > 200"), validation, _uploads(t))


#: Kinds of events that stand for errors, and for successes.
_ERRORS, _SUCCESSES = ("error", "view", "click"), ("purchase", "signup")


def _per_user_day(t: Tables, kinds: tuple[str, ...]):
    """Events of some types, partitioned by user and day."""
    return t.events.where(F.col("event_type").isin(*kinds)).select(
        F.col("user_id").cast("string").alias("exporter"), day().alias("partition_value"), F.col("event_id").alias("event_seq"), "value"
    )


@query("""
select cast(user_id as varchar) as exporter, strftime(ts, '%Y-%m-%d') as partition_value, event_id as event_seq from events e
where event_type in ('error', 'view', 'click') and not exists (select 1 from events c where c.event_type in ('purchase', 'signup') and c.user_id = e.user_id
  and cast(c.ts as date) = cast(e.ts as date) and c.event_id >= e.event_id)
""")
def clear_errors_after_retry(t: Tables):
    errors = _per_user_day(t, _ERRORS).drop("value")
    return ledger.current_errors(errors, _per_user_day(t, _SUCCESSES))


@query("""
with u as (select user_id k, cast(ts as date) d, max(event_id) s from events where event_type in ('purchase', 'signup') group by 1, 2)
select cast(e.user_id as varchar) as exporter, strftime(e.ts, '%Y-%m-%d') as partition_value, e.event_id as failed_at, u.s as success_at
from events e join u on u.k = e.user_id and u.d = cast(e.ts as date) where e.event_type in ('error', 'view', 'click')
""")
def recovered_partitions(t: Tables):
    errors = _per_user_day(t, _ERRORS).withColumnRenamed("event_seq", "created_at")
    uploads = ledger.current_uploads(_per_user_day(t, _SUCCESSES)).withColumnRenamed("event_seq", "uploaded_at")
    return ledger.recovered_partitions(errors, uploads)


@query("""
select distinct cast(user_id as varchar) as exporter, strftime(ts, '%Y-%m-%d') as partition_value from events e
where event_type in ('error', 'view', 'click') and not exists (select 1 from events u where u.event_type in ('purchase', 'signup') and u.user_id = e.user_id
  and cast(u.ts as date) = cast(e.ts as date))
""")
def validation_gaps(t: Tables):
    return ledger.partitions_never_uploaded(_per_user_day(t, _ERRORS), _per_user_day(t, _SUCCESSES))


@query("""
select exporter, w as source_data_watermark from (
  select event_type exporter, strftime(ts, '%Y-%m-%d') w, row_number() over (partition by event_type order by event_id desc, ts desc) r
  from events where value > 20 and value <= 200) where r = 1
""")
def last_watermark(t: Tables):
    runs = event_partitions(t).select(
        "exporter",
        F.col("event_seq").alias("run_id"),
        F.when(F.col("value") > 20, "completed").otherwise("failed").alias("status"),
        F.when(F.col("value") <= 200, F.col("partition_value")).alias("source_data_watermark"),
    )
    return ledger.last_watermarks(runs)


@query("""
select user_id as exporter, cast(max(cast(round(value) as bigint)) as varchar) as source_data_watermark from events group by 1
""")
def furthest_watermark(t: Tables):
    runs = t.events.select(
        F.col("user_id").alias("exporter"),
        F.col("event_id").alias("run_id"),
        F.lit("completed").alias("status"),
        F.round("value").cast("bigint").cast("string").alias("source_data_watermark"),
    )
    return ledger.last_watermarks(runs, "max")


@query("""
with ev as (select event_id // 2 run, event_type x, event_id i, user_id u from events)
select run as run_id, x as exporter, u as records_exported from (
  select *, row_number() over (partition by run order by i desc, x desc, u desc) r from ev) where r = 1
""")
def current_runs(t: Tables):
    # two successive events are the start and the end of one run
    runs = t.events.select(
        F.expr("event_id div 2").alias("run_id"), F.col("event_type").alias("exporter"), F.col("user_id").alias("records_exported"), F.col("event_id").alias("event_seq")
    )
    return ledger.current_runs(runs).drop("event_seq")


@query("""
select event_type as exporter, count(*) filter (where strftime(ts, '%Y-%m-%d') || '.' || event_id like '2024-01-15.%') + 1 as next_suffix from events group by 1
""")
def next_suffix(t: Tables):
    snapshots = event_partitions(t).withColumn("partition_value", F.concat("partition_value", F.lit("."), "event_seq"))
    return ledger.next_suffixes(snapshots, "2024-01-15")


@query("""
with named as (select event_type x, strftime(ts, '%Y-%m-%d') p, event_type || '/' || strftime(ts, '%Y-%m-%d') || '/' || event_id || '.parquet' k, user_id s from events where event_type <> 'error')
select x as exporter, p as partition_value, k as s3_key, cast(0 as bigint) as row_count, s as file_size, 'completed' as status from (
  select *, row_number() over (partition by x, p order by k desc, s desc) r from named) where r = 1
""")
def rebuild_ledger(t: Tables):
    folder = F.when(F.col("event_type") == "error", "latest").otherwise(day())
    key = F.concat_ws("/", "event_type", folder, F.concat("event_id", F.lit(".parquet")))
    objects = t.events.select(key.alias("key"), F.col("user_id").alias("size"))
    rebuilt = ledger.rebuild_uploads(objects, F.lit("2024-02-01 00:00:00"), F.lit(1))
    return rebuilt.select("exporter", "partition_value", "s3_key", "row_count", "file_size", "status")


@query(f"with {_LEDGER_SQL} select x as exporter, count(*) as total, cast(sum(u) as bigint) as total_bytes from uploads group by 1")
def uploads_per_exporter(t: Tables):
    return reports.uploads_per_exporter(_uploads(t)).drop("total_gb")


@query(f"with {_LEDGER_SQL} select x as exporter, min(p) as earliest, max(p) as latest, count(*) as uploaded from uploads group by 1")
def upload_progress(t: Tables):
    return reports.upload_progress(_uploads(t))


@query("select event_type as exporter, count(*) as failures from events group by 1")
def failures_per_exporter(t: Tables):
    return reports.failures_per_exporter(event_partitions(t))


@query("select strftime(ts, '%Y-%m-%d') as partition_value, event_id as uploaded_at, user_id as file_size from events where event_type = 'click'")
def uploads_listing(t: Tables):
    records = event_partitions(t).select(
        "exporter", "partition_value", F.col("event_seq").alias("uploaded_at"), F.col("user_id").alias("file_size")
    )
    return reports.uploads_of(records, "click")


@query("""
select event_type as exporter, strftime(ts, '%Y-%m-%d') as partition_value, 'failed after ' || user_id || ' tries' as error_details,
  user_id as attempts, event_id as created_at from events
""")
def failure_listing(t: Tables):
    errors = event_partitions(t).select(
        "exporter",
        "partition_value",
        F.concat(F.lit("failed after "), "user_id", F.lit(" tries")).alias("error_details"),
        F.col("user_id").alias("attempts"),
        F.col("event_seq").alias("created_at"),
    )
    return reports.failure_listing(errors)


@query("""
select o_orderstatus as exporter, strftime(o_orderdate, '%Y-%m-%d') as partition_value, o_custkey as pq_count, o_orderkey as pg_count,
  o_custkey - o_orderkey as diff, o_orderpriority as error_details, o_orderkey as created_at from orders where o_custkey <> o_orderkey
""")
def validation_diff(t: Tables):
    errors = t.orders.where("o_custkey <> o_orderkey").select(
        F.col("o_orderstatus").alias("exporter"),
        day_text(F.col("o_orderdate")).alias("partition_value"),
        F.col("o_custkey").alias("pq_count"),
        F.col("o_orderkey").alias("pg_count"),
        F.col("o_orderpriority").alias("error_details"),
        F.col("o_orderkey").alias("created_at"),
    )
    return reports.validation_differences(errors)
