"""Inventory, selection, statistics, keys and catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from partflow.catalogue.entries import Tables, day, event_partitions, query
from partflow.functions import keys
from partflow.functions.text import whole_number
from partflow.operators import catalog, selection
from partflow.operators.ledger import current_uploads
from partflow.operators.stats import partition_stats, truth_day_bounds
from partflow.spec import DAILY, EPOCH

STATS_DAILY_SQL = """
select strftime(ts, '%Y-%m-%d') as partition_value, count(*) as row_count,
       min(event_id) as min_slot, max(event_id) as max_slot
from events group by 1
"""


@query(STATS_DAILY_SQL)
def partition_stats_daily(t: Tables):
    return partition_stats(t.events, day(), F.col("event_id"))


@query("select cast(year(l_shipdate) as varchar) as partition_value, count(*) as row_count from lineitem group by 1")
def partition_stats_epoch(t: Tables):
    return partition_stats(t.lineitem, F.year("l_shipdate").cast("string"))


def _range_coverage(rows, value):
    """Rows per exporter on every value from its first to its last, gaps as zero."""
    counts = partition_stats(rows, value, by=["exporter"])
    number = whole_number(F.col("partition_value"))
    first, last = F.min(F.struct(number, "partition_value")), F.max(F.struct(number, "partition_value"))
    text = F.concat(first["partition_value"], F.lit(":"), last["partition_value"])
    ranges = counts.groupBy("exporter").agg(text.alias("text"))
    wanted = ranges.select("exporter", F.explode(keys.range_values(F.col("text"))).alias("partition_value"))
    return wanted.join(counts, ["exporter", "partition_value"], "left").select(
        "exporter", "partition_value", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


@query("""
with bounds as (select event_type x, min(cast(ts as date)) lo, max(cast(ts as date)) hi from events group by 1),
wanted as (select x, unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) d from bounds)
select x as exporter, strftime(d, '%Y-%m-%d') as partition_value, count(e.event_id) as row_count
from wanted left join events e on e.event_type = x and cast(e.ts as date) = cast(d as date) group by 1, 2
""")
def expand_range_daily(t: Tables):
    return _range_coverage(t.events.withColumnRenamed("event_type", "exporter"), day())


@query("""
with bounds as (select l_returnflag x, min(year(l_shipdate)) lo, max(year(l_shipdate)) hi from lineitem group by 1),
wanted as (select x, unnest(range(lo, hi + 1)) y from bounds)
select x as exporter, cast(y as varchar) as partition_value, count(l_orderkey) as row_count
from wanted left join lineitem on l_returnflag = x and year(l_shipdate) = y group by 1, 2
""")
def expand_range_epoch(t: Tables):
    rows = t.lineitem.withColumnRenamed("l_returnflag", "exporter")
    return _range_coverage(rows, F.year("l_shipdate").cast("string"))


@query("""
select event_type as exporter, strftime(ts, '%Y-%m-%d') as partition_value, count(*) as row_count from events
where cast(ts as date) between date '2024-01-05' and date '2024-01-10'
   or strftime(ts, '%Y-%m-%d') in ('2024-01-20', '2023-12-25')
group by 1, 2
""")
def select_partitions(t: Tables):
    stats = partition_stats(t.events.withColumnRenamed("event_type", "exporter"), day(), by=["exporter"])
    wanted = selection.requested_values(
        t.spark, ["2024-01-20", "2023-12-25"], keys.parse_range("2024-01-05:2024-01-10")
    )
    return selection.keep_requested(stats, wanted)


@query("""
with parts as (select event_type x, strftime(ts, '%Y-%m-%d') p, count(*) n from events group by 1, 2),
recorded as (select event_type x, strftime(ts, '%Y-%m-%d') p, value,
    row_number() over (partition by event_type, strftime(ts, '%Y-%m-%d') order by event_id desc, value desc) r
  from events where value > 100),
done as (select x, p from recorded where r = 1 and value <= 200)
select x as exporter, p as partition_value, n as row_count from parts
where not exists (select 1 from done where done.x = parts.x and done.p = parts.p)
""")
def pending_partitions(t: Tables):
    events = event_partitions(t)
    status = F.when(F.col("value") <= 200, "completed").otherwise("failed")
    uploads = current_uploads(events.where("value > 100").drop("user_id").withColumn("status", status))
    stats = events.groupBy("exporter", "partition_value").agg(F.count(F.lit(1)).alias("row_count"))
    return selection.keep_pending(stats, uploads)


@query("""
select strftime(ts, '%Y-%m-%d') as partition_value, min(event_id) as block_min, max(event_id) as block_max
from events group by 1
""")
def truth_day_bounds_from_seconds(t: Tables):
    whole_days = F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86400
    block_time = whole_days + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    blocks = t.events.select(F.col("event_id").alias("slot"), block_time.alias("block_time"))
    return truth_day_bounds(blocks, keys.day_of_epoch_seconds(F.col("block_time")).cast("string"), F.col("slot"))


@query("""
select event_id, event_type || '/' || strftime(ts, '%Y-%m-%d') || '/' || event_type || '-' || strftime(ts, '%Y-%m-%d')
  || '.parquet' as daily_key,
  event_type || '/' || user_id || '/' || event_type || '-epoch-' || user_id || '.parquet' as epoch_key
from events
""")
def key_build(t: Tables):
    name, user = F.col("event_type"), F.col("user_id").cast("string")
    return t.events.select(
        "event_id",
        keys.object_key(name, day(), F.lit(DAILY)).alias("daily_key"),
        keys.object_key(name, user, F.lit(EPOCH)).alias("epoch_key"),
    )


@query("""
select event_id, event_type as exporter,
  case when event_type = 'click' then cast(user_id as varchar) else strftime(ts, '%Y-%m-%d') end as partition_value,
  case event_type when 'view' then 'view-' || strftime(ts, '%Y-%m-%d') || '.parquet'
    when 'click' then 'click-epoch-' || user_id || '.parquet'
    when 'signup' then 'signup-' || strftime(ts, '%Y-%m-%d') || '.2.parquet'
    when 'purchase' then 'parts/' || event_id || '.parquet' end as file_name,
  case when event_type = 'click' then 'epoch' else 'daily' end as partition_type
from events where event_type <> 'error'
""")
def key_parse(t: Tables):
    name, user = F.col("event_type"), F.col("user_id").cast("string")
    key = (
        F.when(name == "view", keys.object_key(name, day(), F.lit(DAILY)))
        .when(name == "click", keys.object_key(name, user, F.lit(EPOCH)))
        .when(name == "signup", F.concat(name, F.lit("/"), day(), F.lit("/"), name, F.lit("-"), day(), F.lit(".2.parquet")))
        .when(name == "purchase", F.concat(name, F.lit("/"), day(), F.lit("/parts/"), "event_id", F.lit(".parquet")))
        .otherwise(F.concat(name, F.lit("/latest/"), day(), F.lit(".parquet")))
    )
    parsed = t.events.select("event_id", keys.parse_key(key).alias("parsed")).where(F.col("parsed").isNotNull())
    kind = keys.partition_type_of(F.col("parsed.partition_value"))
    return parsed.select("event_id", "parsed.*", kind.alias("partition_type"))


@query("""
select event_id, case when event_type = 'click' then 'click/' || user_id || '/f.parquet'
  else event_type || '/' || strftime(ts, '%Y-%m-%d') || '/f.parquet' end as new_key from events
""")
def key_migrate(t: Tables):
    name = F.col("event_type")
    old = F.when(name == "click", F.concat(name, F.lit("/epoch="), "user_id", F.lit("/f.parquet"))).otherwise(
        F.concat(name, F.lit("/date="), day(), F.lit("/f.parquet"))
    )
    return t.events.select("event_id", keys.migrate_key(old).alias("new_key"))


def _objects(t: Tables):
    """Events as published objects: one key per event, its user as size; a few lie elsewhere."""
    name = F.col("event_type")
    daily = F.concat_ws("/", name, day(), F.concat(F.col("event_id"), F.lit(".parquet")))
    by_epoch = F.concat_ws("/", name, F.col("user_id"), F.concat(F.col("event_id"), F.lit(".csv")))
    deep = F.concat_ws("/", name, F.lit("old"), day(), F.concat(F.col("event_id"), F.lit(".parquet")))
    key = F.when(F.col("value") > 200, deep).when(name == "click", by_epoch).otherwise(daily)
    return t.events.select(key.alias("key"), F.col("user_id").alias("size"), F.col("ts").alias("last_modified"))


_ENTRIES_SQL = """
entries as (select event_type x, user_id s, case when event_type = 'click' then 'epoch' else 'daily' end kind,
  case when event_type = 'click' then cast(user_id as varchar) else strftime(ts, '%Y-%m-%d') end p,
  event_id || case when event_type = 'click' then '.csv' else '.parquet' end f from events where value <= 200)
"""


@query(f"""
with {_ENTRIES_SQL}
select x as exporter, kind as partition_type, count(*) as total_files, cast(sum(s) as bigint) as total_size_bytes,
  min(p) as earliest_partition, max(p) as latest_partition from entries group by 1, 2
""")
def manifest_by_exporter(t: Tables):
    return catalog.manifest_summary(catalog.manifest_entries(_objects(t)))


@query(f"""
with {_ENTRIES_SQL}
select count(*) as total_files, cast(sum(s) as bigint) as total_size_bytes, count(distinct x) as exporters,
  round(sum(s) / 1073741824.0, 2) as total_size_gb from entries
""")
def manifest_totals(t: Tables):
    return catalog.manifest_totals(catalog.manifest_summary(catalog.manifest_entries(_objects(t))))


@query(f"""
with {_ENTRIES_SQL}
select x as exporter, p as partition_value, kind as partition_type, x || '/' || p || '/' || f as s3_key,
  f as file_name, s as file_size_bytes from entries
""")
def manifest_listing(t: Tables):
    return catalog.manifest_entries(_objects(t)).drop("last_modified")


@query("""
select event_type as exporter, case when value > 200 then event_type || '/old/' else event_type || '/' end
  || strftime(ts, '%Y-%m-%d') || '/' || event_id || '.parquet' as file from events where value > 200 or event_type <> 'click'
""")
def file_index(t: Tables):
    return catalog.file_index(_objects(t))


@query("""
select event_type as exporter, count(*) as file_count from events where value > 200 or event_type <> 'click' group by 1
""")
def file_counts(t: Tables):
    return catalog.file_counts(catalog.file_index(_objects(t)))
