"""Whole jobs over the given tables: they write below the shared folder and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.catalogue.entries import Tables, day, query
from partflow.catalogue.keyed import _PROFILE_SQL, _batch, _existing_profile, _registrations, _responses
from partflow.catalogue.partitions import _ENTRIES_SQL, STATS_DAILY_SQL, _objects
from partflow.catalogue.quality import _EXPORT_SQL, _MEASURES_SQL, _authority, _export, _export_measures
from partflow.functions.documents import resolve_pools
from partflow.functions.keys import source_date
from partflow.operators import profile
from partflow.operators.assets import STABLECOIN
from partflow.operators.enrich import Enrichment, enrich
from partflow.operators.ledger import run_summary
from partflow.operators.measures import MEASURES
from partflow.plans.assets import export_snapshot
from partflow.plans.corrections import rewrite_measures
from partflow.plans.enrichment import run_enrichment
from partflow.plans.migrate import migrate_layout
from partflow.plans.profile import PROFILE_NAME, REGISTRATIONS, build_profile, pending_lookups
from partflow.plans.publish import PublishJob, Truth, publish_all, publish_dataset, retry_failed, validate_partitions
from partflow.plans.reference_data import POOL_DATA, POOL_REGISTRATIONS, REGISTRY, export_pools, export_registry
from partflow.scratch import materialise, new_dir
from partflow.sinks.documents import write_documents
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.manifests import read_manifest_document, write_manifest_document
from partflow.sinks.partitions import HIVE, publish_partitions, published_stats
from partflow.sinks.snapshots import write_snapshot
from partflow.sinks.versions import compact_versions, highest_versions
from partflow.sources.documents import read_documents, read_responses
from partflow.sources.inventory import inventory
from partflow.sources.partitions import footer_stats, read_exports, read_partition, read_partitions, read_snapshot, read_with_source
from partflow.sources.storage import Move, Retry, Storage
from partflow.spec import DAILY, EPOCH, POOL_DATA_SCHEMA, PROFILE_SCHEMA, REGISTRY_SCHEMA, DatasetSpec
from partflow.streaming.discover import collect_stats, file_stream
from partflow.streaming.publish import publish_new_partitions

_NOW = dt.datetime(2024, 2, 1)
_EVENTS = DatasetSpec("events", "events", "event_id", DAILY)
_ORDERS = DatasetSpec("orders", "orders", "o_orderkey", EPOCH)


def _land(rows, spec: DatasetSpec) -> str:
    """Write rows as a Hive-partitioned dataset; returns its base directory."""
    base = new_dir(rows.sparkSession, "landed")
    publish_partitions(rows, base, spec, HIVE)
    return base


def _land_events(t: Tables) -> str:
    return _land(t.events.withColumn("partition_value", day()), _EVENTS)


@query(STATS_DAILY_SQL)
def stream_partition_stats(t: Tables):
    events = f"{t.folder}/events.parquet"
    stream = file_stream(t.spark, events, t.events.schema)
    work = new_dir(t.spark, "stream")
    return collect_stats(stream, day(), F.col("event_id"), f"{work}/state", f"{work}/checkpoint")


@query(STATS_DAILY_SQL)
def publish_roundtrip(t: Tables):
    rows = t.events.withColumn("partition_value", day())
    target = new_dir(t.spark, "published")
    values = publish_partitions(rows, target, _EVENTS)
    return published_stats(rows, target, _EVENTS, values, F.col("event_id"))


@query(STATS_DAILY_SQL)
def partition_stats_from_footers(t: Tables):
    base = _land_events(t)
    values = [row.partition_value for row in inventory(t.spark, base, _EVENTS).toLocalIterator()]
    return footer_stats(t.spark, base, _EVENTS, values, "event_id")


@query("select distinct 'events' as exporter, strftime(ts, '%Y-%m-%d') as partition_value, 'daily' as partition_type from events")
def inventory_scan(t: Tables):
    listed = inventory(t.spark, _land_events(t), _EVENTS)
    return listed.where("file_size > 0").select("exporter", "partition_value", "partition_type")


_OUTCOME_SQL = f"""
with {_EXPORT_SQL},
pq as (select p, count(*) n, min(event_id) lo, max(event_id) hi from ex group by 1),
blk as (select strftime(ts, '%Y-%m-%d') p, min(event_id) blo, max(event_id) bhi from events group by 1),
cnt as (select pq.p, count(e.event_id) c from pq left join events e on e.event_id between pq.lo and pq.hi group by 1),
verdict as (select pq.p, coalesce(n = c and lo >= blo and hi <= bhi, false) ok from pq left join blk on pq.p = blk.p join cnt on cnt.p = pq.p)
"""


@query(f"""
{_OUTCOME_SQL}
select 'events' as exporter, count(*) as scanned, cast(0 as bigint) as skipped_existing, count(*) as validated,
  count(*) filter (where not ok) as validation_errors, count(*) filter (where ok) as uploaded, cast(0 as bigint) as upload_errors from verdict
""")
def publish_run(t: Tables):
    base = _land(_export(t), _EVENTS)
    job = PublishJob(base, new_dir(t.spark, "published"), Ledger(t.spark, new_dir(t.spark, "ledger")))
    truth = Truth(t.events, t.events, "event_id", day())
    return run_summary(publish_dataset(t.spark, job, _EVENTS, truth, _NOW))


@query(f"""
{_OUTCOME_SQL}
select 'events' as exporter, p as partition_value, case when ok then 1 else 2 end as run from verdict
""")
def retry_after_failures(t: Tables):
    # the second run retries what the first found invalid, without validation
    base = _land(_export(t), _EVENTS)
    ledger = Ledger(t.spark, new_dir(t.spark, "ledger"))
    job = PublishJob(base, new_dir(t.spark, "published"), ledger)
    truth = Truth(t.events, t.events, "event_id", day())
    materialise(publish_dataset(t.spark, job, _EVENTS, truth, _NOW), "first-run")
    retry_failed(t.spark, job, {"events": (_EVENTS, None)}, _NOW)
    still_open = ledger.errors("validation_errors").select("exporter", "partition_value")
    uploads = ledger.uploads().join(still_open, ["exporter", "partition_value"], "left_anti")
    return uploads.select("exporter", "partition_value", F.col("event_seq").cast("int").alias("run"))


def _spoiled(t: Tables) -> str:
    """Events by day, some days spoiled by their day of the month: modulo 4, 0 is unreadable, 1 half unreadable, 2 without rows."""
    kind = F.dayofmonth(F.to_date("partition_value")) % 4
    rows = t.events.withColumn("partition_value", day())
    base = new_dir(t.spark, "spoiled")
    root, storage = f"{base}/events", Storage(t.spark)
    publish_partitions(rows.where(kind.isin(1, 3)), base, _EVENTS, HIVE)
    days = rows.select("partition_value", kind.alias("kind")).distinct()
    for r in days.where("kind <> 3").toLocalIterator():
        folder = f"{root}/date={r.partition_value}"
        if r.kind == 1:  # not the only file any more, so no longer the partition by its name
            storage.rename(f"{folder}/events-{r.partition_value}.parquet", f"{folder}/a.parquet")
        if r.kind == 2:
            t.events.where("false").write.parquet(folder)
        else:
            t.spark.range(1).select(F.lit("no parquet").alias("line")).coalesce(1).write.text(f"{base}/broken/{r.partition_value}")
            part = storage.matching(f"{base}/broken/{r.partition_value}/part-*")[0]
            storage.make_directory(folder)
            storage.rename(part, f"{folder}/b.parquet")
    return base


@query("""
select strftime(ts, '%Y-%m-%d') as partition_value,
  case when day(ts) % 4 = 2 then 'Partition holds no rows' else 'Parquet read error: unreadable file' end as error_details
from events where day(ts) % 4 <> 3 group by 1, 2
""")
def suspect_partitions(t: Tables):
    job = PublishJob(_spoiled(t), "", Ledger(t.spark, new_dir(t.spark, "ledger")), t.events.schema)
    pending = materialise(inventory(t.spark, job.base, _EVENTS), "inventory")
    verdicts = validate_partitions(job, _EVENTS, pending, None)
    return verdicts.where("error_details IS NOT NULL").select("partition_value", "error_details")


@query("""
select run, strftime(ts, '%Y-%m-%d') as partition_value, case when day(ts) % 4 = 3 then 'uploaded' else 'invalid' end as outcome
from events, (values ('truth'), ('no truth'), ('no schema')) as r(run) group by all
""")
def publish_with_broken_file(t: Tables):
    base, found = _spoiled(t), None
    truth = Truth(t.events, t.events, "event_id", day())
    for run, table, schema in (("truth", truth, t.events.schema), ("no truth", None, t.events.schema), ("no schema", None, None)):
        job = PublishJob(base, new_dir(t.spark, "published"), Ledger(t.spark, new_dir(t.spark, "ledger")), schema)
        part = publish_dataset(t.spark, job, _EVENTS, table, _NOW).select(F.lit(run).alias("run"), "partition_value", "outcome")
        found = part if found is None else found.unionByName(part)
    return found


@query("""
with n as (select 'events' as exporter, count(distinct strftime(ts, '%Y-%m-%d')) as n from events
  union all select 'orders', count(distinct year(o_orderdate)) from orders)
select exporter, n as scanned, cast(0 as bigint) as skipped_existing, n as validated, cast(0 as bigint) as validation_errors,
  n as uploaded, cast(0 as bigint) as upload_errors, cast(null as varchar) as error_details from n
""")
def publish_every_dataset(t: Tables):
    orders = t.orders.withColumn("partition_value", F.year("o_orderdate").cast("string"))
    yearly = DatasetSpec("orders", "orders", "o_year", EPOCH)
    ledger, target = Ledger(t.spark, new_dir(t.spark, "ledger")), new_dir(t.spark, "published")
    jobs = {
        "events": (PublishJob(_land_events(t), target, ledger), Truth(t.events, t.events, "event_id", day())),
        "orders": (PublishJob(_land(orders, yearly), target, ledger), Truth(t.orders.select(F.year("o_orderdate").alias("o_year")))),
    }
    return publish_all(t.spark, jobs, [_EVENTS, yearly], _NOW)


@query("select event_id, user_id, strftime(ts, '%Y-%m-%d') as source_date from events")
def rows_with_source(t: Tables):
    schema = T.StructType([f for f in t.events.schema.fields if f.name in ("event_id", "user_id")])
    return read_with_source(t.spark, _land_events(t), _EVENTS, schema)


@query("""
select event_id, user_id, strftime(ts, '%Y-%m-%d') as source_date from events
where strftime(ts, '%Y-%m-%d') = (select max(strftime(ts, '%Y-%m-%d')) from events)
""")
def newest_partition_alone(t: Tables):
    # one partition is the feature: its columns come from the file, its day from where the file lies
    newest = inventory(t.spark, _land_events(t), _EVENTS).orderBy(F.desc("partition_value")).first()
    rows = read_partition(t.spark, newest.file_path)
    return rows.select("event_id", "user_id", source_date(F.col("_metadata.file_path")).alias("source_date"))


@query("""
select distinct 'events' as exporter, strftime(ts, '%Y-%m-%d') as partition_value from events
""")
def streamed_publication(t: Tables):
    # two batches: the days of the first half of the month land before the first, the rest before the second
    rows = t.events.withColumn("partition_value", day())
    early = F.dayofmonth("ts") <= 15
    work = new_dir(t.spark, "stream")
    job = PublishJob(f"{work}/landed", f"{work}/published", Ledger(t.spark, f"{work}/ledger"))
    for part in (early, ~early):
        publish_partitions(rows.where(part), job.base, _EVENTS, HIVE)
        publish_new_partitions(t.spark, job, _EVENTS, Truth(t.events, t.events, "event_id", day()), _NOW, f"{work}/checkpoint")
    return job.ledger.uploads().select("exporter", "partition_value")


@query("""
select 'events' as exporter, strftime(ts, '%Y-%m-%d') as partition_value, count(*) as row_count, count(*) as found_row_count, true as is_published
from events group by 1, 2
""")
def layout_migration(t: Tables):
    checked = migrate_layout(t.spark, _land_events(t), new_dir(t.spark, "bare"), [_EVENTS], _NOW)
    return checked.select("exporter", "partition_value", "row_count", "found_row_count", "is_published")


@query("""
with days as (select strftime(ts, '%Y-%m-%d') as d, day(ts) % 4 as kind, count(*) as n from events group by all)
select d as partition_value, kind = 3 as is_published, case when kind = 3 then n end as found_row_count,
  case when kind = 2 then 'Partition holds no rows' when kind <> 3 then 'Parquet read error: unreadable file' end as error_details,
  case when kind = 3 then 'events/' else 'events/date=' end || d || '/events-' || d || '.parquet' as s3_key from days
""")
def layout_migration_with_broken_files(t: Tables):
    # whole partitions move, and their keys in the ledger; the others stay where they are
    ledger, base = Ledger(t.spark, new_dir(t.spark, "ledger")), _spoiled(t)
    days = t.events.select(F.lit("events").alias("exporter"), day().alias("partition_value")).distinct()
    old = F.format_string("events/date=%1$s/events-%1$s.parquet", "partition_value")
    ledger.append("uploads", days.select("*", old.alias("s3_key"), F.lit("completed").alias("status"), F.lit(0).alias("event_seq")))
    checked = migrate_layout(t.spark, base, new_dir(t.spark, "bare"), [_EVENTS], _NOW, ledger)
    moved = checked.select("partition_value", "is_published", F.when(F.col("is_published"), F.col("found_row_count")).alias("found_row_count"), "error_details")
    return moved.join(ledger.uploads().select("partition_value", "s3_key"), "partition_value")


@query("""
select 'events/date=' || strftime(ts, '%Y-%m-%d') as old_directory, 'events/' || strftime(ts, '%Y-%m-%d') as new_directory from events group by 1, 2
""")
def layout_migration_dry_run(t: Tables):
    moves = migrate_layout(t.spark, _land_events(t), new_dir(t.spark, "bare"), [_EVENTS], _NOW, dry_run=True)
    directory = lambda key: F.substring_index(key, "/", 2)
    return moves.select(directory("old_key").alias("old_directory"), directory("new_key").alias("new_directory")).distinct()


@query(f"""
with {_PROFILE_SQL},
j as (select coalesce(ex.k, n.k) k, ex.st est,
    case when n.k is null or (ex.b is not null and n.b <= ex.b) then 'pass' when not has_url then 'no_url' when resp.v <= 60 then 'success' else 'failed' end a
  from ex full join n on ex.k = n.k left join resp on resp.k = n.k)
select cast(k as varchar) as drep_id, case when a = 'pass' or (a <> 'success' and coalesce(est = 'success', false)) then est else a end as fetch_status from j
""")
def profile_snapshot_roundtrip(t: Tables):
    # the update reads the snapshot it supersedes
    root = new_dir(t.spark, "profile")
    write_snapshot(_existing_profile(t), root, "000001", "drep_id")
    existing = read_snapshot(t.spark, root, PROFILE_SCHEMA)
    batch = profile.answered_batch(_batch(t), _responses(t))
    write_snapshot(profile.merge_profiles(existing, batch, "now"), root, "000002", "drep_id")
    return read_snapshot(t.spark, root, PROFILE_SCHEMA, ["drep_id", "fetch_status"])


@query("""
select o_orderkey, o_custkey, c_name as drep_name, cast(year(o_orderdate) as varchar) as partition_value
from orders left join (select c_custkey k, max(c_name) c_name from customer where c_acctbal >= 0 group by 1) on o_custkey = k
""")
def enrichment_run(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("partition_value"))
    names = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("drep_name"))
    job = Enrichment("orders_enriched", "orders", lambda fact: enrich(fact, names, "o_custkey", ["drep_name"]))
    target = new_dir(t.spark, "enriched")
    ledger = Ledger(t.spark, new_dir(t.spark, "ledger"))
    run_enrichment(t.spark, job, _land(rows, _ORDERS), target, ledger, _NOW, layout=HIVE)
    published = read_partitions(t.spark, target, DatasetSpec("orders_enriched", "", "", EPOCH))
    return published.select("o_orderkey", "o_custkey", "drep_name", "partition_value")


class _Refusing(Storage):
    """Storage that has no room for some partitions."""

    def replace(self, move: Move) -> None:
        if move.target.endswith("-05"):
            raise OSError(f"cannot move {move.source} to {move.target}")
        super().replace(move)


@query("""
select 'events' as exporter, strftime(ts, '%Y-%m-%d') as partition_value,
  case when day(ts) = 5 then 'upload_failed' else 'uploaded' end as outcome, case when day(ts) = 5 then 3 end as attempts
from events group by all
""")
def publish_with_blocked_target(t: Tables):
    ledger = Ledger(t.spark, new_dir(t.spark, "ledger"))
    job = PublishJob(
        _land_events(t), new_dir(t.spark, "published"), ledger, t.events.schema, retry=Retry(3, 0, 0), storage=_Refusing
    )
    results = publish_dataset(t.spark, job, _EVENTS, Truth(t.events, t.events, "event_id", day()), _NOW)
    recorded = ledger.uploads().select("exporter", "partition_value", F.lit("uploaded").alias("recorded"))
    errors = ledger.errors("upload_errors").select("exporter", "partition_value", "attempts")
    beside = results.join(recorded, ["exporter", "partition_value"], "left").join(errors, ["exporter", "partition_value"], "left")
    # what was moved and not recorded, or the other way round, would show
    outcome = F.when(F.col("outcome") == F.coalesce("recorded", F.lit("upload_failed")), F.col("outcome")).otherwise("unrecorded")
    return beside.select("exporter", "partition_value", outcome.alias("outcome"), "attempts")


@query(f"""
with {_MEASURES_SQL}
select own.k as epoch, case when auth.k is null then own.treasury else auth.treasury end as treasury,
  case when auth.k is null then own.reserves else auth.reserves end as reserves,
  case when auth.k is null then own.fees else auth.fees end as fees,
  case when auth.k is null then own.deposits_stake else auth.deposits_stake end as deposits_stake,
  own.reserves as rewards_pot, cast(fees_of.y as varchar) as partition_value
from own left join auth on own.k = auth.k join (select o_orderkey k, year(o_orderdate) y from orders) fees_of on fees_of.k = own.k
""")
def measure_rewrite(t: Tables):
    own = _export_measures(t).join(t.orders.select(F.col("o_orderkey").alias("epoch"), F.year("o_orderdate").cast("string").alias("partition_value")), "epoch")
    authority = _authority(own)
    filed = own.select("epoch", *MEASURES, "rewards_pot", "partition_value")
    base, ledger = _land(filed, _ORDERS), Ledger(t.spark, new_dir(t.spark, "ledger"))
    rewrite_measures(t.spark, base, _ORDERS, authority, "epoch", ledger, _NOW)
    schema = T.StructType([f for f in filed.schema.fields if f.name not in ("partition_value", "epoch")])
    rows = t.spark.read.option("recursiveFileLookup", True).parquet(f"{base}/orders")
    year = F.regexp_extract(F.col("_metadata.file_path"), "/epoch=([^/]+)/[^/]+$", 1).alias("partition_value")
    return rows.select("epoch", *[f.name for f in schema.fields], year)


@query("""
select 'asset_data' as exporter, d || '.' || n as partition_value,
  count(*) filter (where p_size <= case when n = 1 then 25 else 50 end and not (p_name like 'hot %' and p_type = 'ECONOMY')) as row_count
from part, (values ('2024-02-01', 1), ('2024-02-01', 2), ('2024-02-02', 1)) as s(d, n) group by d, n
""")
def asset_snapshots(t: Tables):
    # a morning and an evening snapshot, the morning's run repeated, and the next day's
    assets = t.part.select(
        "p_partkey", "p_size", F.lit(None).cast("string").alias("ticker"), F.col("p_name").alias("name"),
        F.when(F.col("p_type") == "ECONOMY", STABLECOIN).otherwise(F.col("p_type")).alias("category"),
        F.col("p_name").startswith("hot ").alias("is_meme"),
    )
    small = assets.where("p_size <= 25")
    target, ledger = new_dir(t.spark, "published"), Ledger(t.spark, new_dir(t.spark, "ledger"))
    for rows, hours in ((small, 8), (assets, 20), (small, 8), (small, 32)):
        export_snapshot(t.spark, rows, target, ledger, _NOW + dt.timedelta(hours=hours))
    return ledger.uploads().select("exporter", "partition_value", "row_count")


@query("""
with days as (select distinct cast(o_custkey as varchar) as pool_hash, day, '2024-02-0' || day as exported
    from (select o_custkey, case when o_orderpriority < '3' then 1 when o_orderpriority < '4' then 2 else 3 end as day from orders)),
rows as (select 'row' as kind, pool_hash as name, exported as day, cast(row_number() over (partition by pool_hash order by day) as bigint) as n from days)
select * from rows union all select 'upload', 'off_chain_pool_data', exported, count(*) from days group by exported
""")
def pool_exports(t: Tables):
    # three runs, each after another day of registrations; a pool registered again gets a new version
    rank = F.col("o_orderpriority")
    number = F.when(rank < "3", 1).when(rank < "4", 2).otherwise(3)
    pools = t.orders.select(F.col("o_custkey").cast("string").alias("pool_id"), number.alias("number"))
    base, out, ledger = new_dir(t.spark, "landed"), new_dir(t.spark, "exports"), Ledger(t.spark, new_dir(t.spark, "ledger"))
    document = F.to_json(F.struct(F.col("pool_id"), F.lit("T").alias("ticker")))
    answers = pools.select("pool_id").distinct().select(
        F.col("pool_id").alias("id"), F.lit(200).alias("http_status"), document.alias("body"),
        F.lit(None).cast("string").alias("transport_error"), F.lit(_NOW).alias("fetched_at"),
    )
    answers = materialise(answers, "answers")
    for n in (1, 2, 3):
        day_rows = pools.where(F.col("number") == n).select("pool_id", F.lit(f"2024-01-0{n}").alias("partition_value"))
        publish_partitions(day_rows, base, POOL_REGISTRATIONS, HIVE)
        export_pools(t.spark, base, out, answers, ledger, _NOW + dt.timedelta(days=n - 1))
    rows = read_exports(t.spark, out, POOL_DATA, POOL_DATA_SCHEMA)
    exported = rows.select(F.lit("row").alias("kind"), F.col("pool_hash").alias("name"), F.col("date").alias("day"), F.col("version").cast("bigint").alias("n"))
    uploads = ledger.uploads().select(F.lit("upload").alias("kind"), F.col("exporter").alias("name"), F.col("partition_value").alias("day"), F.col("row_count").alias("n"))
    return exported.unionAll(uploads)


@query("""
with s as (select cast(s_suppkey as varchar) as h, bool_or(s_acctbal >= 0) as early from supplier group by 1)
select 'row' as kind, h as name, '2024-02-01' as day, cast(1 as bigint) as n from s where early
union all select 'row', h, '2024-02-02', case when early then 2 else 1 end from s
union all select 'upload', 'smart_contract_registry', '2024-02-01', count(*) from s where early
union all select 'upload', 'smart_contract_registry', '2024-02-02', count(*) from s
union all select 'held', case when early then 'crfa_v2' else 'stricahq' end, null, count(*) from s group by early
union all select 'source', 'crfa_v2', 'c1', 0 union all select 'source', 'stricahq', 's1', 0
""")
def registry_export(t: Tables):
    # the first run finds the files of one source only, the second those of the better one as well, the third nothing new
    suppliers = t.supplier.groupBy(F.col("s_suppkey").cast("string").alias("h")).agg(
        F.min("s_name").alias("title"), F.bool_or(F.col("s_acctbal") >= 0).alias("early"), F.expr("first(s_suppkey div 50)").alias("bucket")
    )
    suppliers = materialise(suppliers, "contracts")
    item = F.struct(F.col("h").alias("scriptHash"), F.col("title").alias("name"))

    def files(rows, folder: str, project: str, member: str):
        grouped = rows.groupBy("bucket").agg(F.collect_list(item).alias(member))  # at most 50 a file
        document = F.struct(F.concat(F.lit("P"), "bucket").alias(project), F.lit("DeFi").alias("category"), member)
        return grouped.select(F.format_string(folder + "/%d.json", "bucket").alias("path"), F.to_json(document).alias("content"))

    best = files(suppliers, "projects", "projectName", "contracts")
    other = files(suppliers.where("early"), "dApps_v2", "dAppName", "scripts")
    latest = t.spark.createDataFrame([("stricahq", "s1"), ("crfa_v2", "c1")], "source string, latest_sha string")
    out, ledger = new_dir(t.spark, "exports"), Ledger(t.spark, new_dir(t.spark, "ledger"))
    for n, landed in enumerate(({"crfa_v2": other}, {"crfa_v2": other, "stricahq": best}, {"crfa_v2": other, "stricahq": best})):
        export_registry(t.spark, out, landed, latest, ledger, _NOW + dt.timedelta(days=n))
    rows = read_exports(t.spark, out, REGISTRY, REGISTRY_SCHEMA)
    exported = rows.select(F.lit("row").alias("kind"), F.col("script_hash").alias("name"), F.col("date").alias("day"), F.col("version").cast("bigint").alias("n"))
    uploads = ledger.uploads().select(F.lit("upload"), "exporter", "partition_value", "row_count")
    holders = ledger.registry_hashes().groupBy("script_hash").agg(F.concat_ws(", ", F.sort_array(F.collect_set("source"))).alias("by"))
    held = holders.groupBy("by").agg(F.count("*").alias("n")).select(F.lit("held"), "by", F.lit(None).cast("string"), "n")
    state = ledger.registry_state().select(F.lit("source"), "source", "last_commit_sha", F.lit(0).cast("bigint"))
    return exported.unionAll(uploads).unionAll(held).unionAll(state)


@query("""
select cast(o_custkey as varchar) as pool_hash, cast(max(n) as integer) as max_version
from (select o_custkey, count(*) as n from orders group by o_custkey, year(o_orderdate)) group by 1
""")
def compacted_versions(t: Tables):
    # an export for each year, its versions the orders of the year; after every third the versions so far are written as one state
    key, out = POOL_DATA_SCHEMA["pool_hash"], new_dir(t.spark, "exports")
    years = t.orders.groupBy(F.col("o_custkey").cast("string").alias("pool_hash"), F.year("o_orderdate").alias("year"))
    counts = materialise(years.agg(F.count("*").cast("int").alias("version")), "counts")
    for (year,) in counts.select("year").distinct().orderBy("year").toLocalIterator():
        counts.where(F.col("year") == year).drop("year").write.parquet(f"{out}/{POOL_DATA}/date={year}-12-31/export={year}")
        compact_versions(t.spark, out, POOL_DATA, key, after=3)
    return highest_versions(t.spark, out, POOL_DATA, key)


@query("""
with types as (select event_type as exporter, count(*) as n, max(value) > 300 as broke_off from events group by 1)
select exporter, 'first' as run, n as records_fetched, 'completed' as status, false as told from types where not broke_off
union all select exporter, 'first', 0, 'failed', true from types where broke_off
union all select exporter, 'second', n, 'completed', false from types
""")
def abandoned_runs(t: Tables):
    # the drivers of some exporters died in their first run; two days later the second one closes it
    ledger = Ledger(t.spark, new_dir(t.spark, "ledger"))
    types = t.events.groupBy("event_type").agg(F.count("*").alias("n"), (F.max("value") > 300).alias("broke_off"))
    kinds = types.orderBy("event_type").toLocalIterator()  # the few types of events
    for kind in list(kinds):
        for when, broke_off in ((_NOW, kind.broke_off), (_NOW + dt.timedelta(days=2), False)):
            run = ledger.start_run(kind.event_type, when)
            if not broke_off:
                ledger.complete_run(run, when, kind.n, kind.n)
    named = F.when(F.col("run_started_at") < F.lit(_NOW + dt.timedelta(days=1)), "first").otherwise("second")
    told = F.coalesce(F.col("error_details").contains("broke off"), F.lit(False))
    return ledger.runs().select("exporter", named.alias("run"), "records_fetched", "status", told.alias("told"))


_REBUILT_SQL = """
reg as (select user_id k, event_id b, event_type = 'signup' and value > 80 has_url, strftime(ts, '%Y-%m-%d') d from events),
early as (select k, max(b) b, bool_or(has_url) has_url, arg_max(d, b) d from reg where d < '2024-01-29' group by 1),
late as (select k, max(b) b, bool_or(has_url) has_url, arg_max(d, b) d from reg where d >= '2024-01-29' group by 1),
resp as (select user_id k, arg_max(value, event_id) v from events where event_type = 'view' group by 1),
one as (select early.k, b, d, case when not has_url then 'no_url' when v <= 60 then 'success' else 'failed' end st
  from early left join resp on resp.k = early.k),
two as (select coalesce(one.k, late.k) k, one.b ob, one.d od, one.st ost, late.b nb, late.d nd,
    case when late.k is null or (one.b is not null and late.b <= one.b) then 'pass' when not has_url then 'no_url'
      when v <= 60 then 'success' else 'failed' end a
  from one full join late on one.k = late.k left join resp on resp.k = late.k),
done as (select *, a = 'pass' or (a <> 'success' and coalesce(ost = 'success', false)) keep from two)
"""


@query(f"""
with {_REBUILT_SQL}
select 'after rebuild' as stage, cast(k as varchar) as drep_id, st as fetch_status, b as source_block, d as source_date,
  'rebuilt' as last_checked_at, 'rebuilt' as updated_at from one
union all select 'after update', cast(k as varchar), case when keep then ost else a end, case when keep then ob else nb end,
  case when keep then od else nd end, case when a = 'pass' then 'rebuilt' else 'updated' end, case when keep then 'rebuilt' else 'updated' end from done
union all select 'to look up', cast(late.k as varchar), null, null, null, null, null from late left join one on one.k = late.k
  where has_url and (one.b is null or late.b > one.b)
""")
def profile_job(t: Tables):
    # all days but the last ones; then these: the lookups that are due, a dry run and the update itself
    base, out = new_dir(t.spark, "landed"), new_dir(t.spark, "profiles")
    events, late = t.events, F.col("ts") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    rows = lambda some: _registrations(t, some).withColumnRenamed("source_date", "partition_value")
    answers = materialise(_responses(t), "answers")
    publish_partitions(rows(events.where(~late)), base, REGISTRATIONS, HIVE)
    build_profile(t.spark, base, out, answers, "b", "rebuilt", rebuild=True)
    days = publish_partitions(rows(events.where(late)), base, REGISTRATIONS, HIVE)
    due = materialise(pending_lookups(t.spark, base, out, days), "due")
    build_profile(t.spark, base, out, answers, "c", "dry", dates=days, dry_run=True)
    columns = ["drep_id", "fetch_status", "source_block", "source_date", "last_checked_at", "updated_at"]
    read = lambda: read_snapshot(t.spark, f"{out}/{PROFILE_NAME}", PROFILE_SCHEMA, columns).select(*columns)
    before = read().select(F.lit("after rebuild").alias("stage"), "*")
    # a label before the first one's: the pointer says which is current
    build_profile(t.spark, base, out, answers, "a", "updated", dates=days)
    after = read().select(F.lit("after update").alias("stage"), "*")
    return before.unionByName(after).unionByName(due.select(F.lit("to look up").alias("stage"), "drep_id"), allowMissingColumns=True)


@query(f"""
with {_ENTRIES_SQL}
select 'partition' as kind, x as exporter, p as partition_value, kind as partition_type, x || '/' || p || '/' || f as s3_key,
  f as file_name, s as file_size_bytes, cast(1 as bigint) as files from entries
union all select 'exporter', x, max(p), arg_min(kind, x || '/' || p || '/' || f), null, min(p), cast(sum(s) as bigint), count(*) from entries group by x
""")
def manifest_readback(t: Tables):
    # one document in parts, read back line by line
    target = f"{new_dir(t.spark, 'manifest')}/document"
    write_manifest_document(_objects(t), target, _NOW)
    summary, entries = read_manifest_document(t.spark, target)
    listed = entries.select(
        F.lit("partition").alias("kind"), "exporter", "partition_value", "partition_type", "s3_key", "file_name",
        "file_size_bytes", F.lit(1).cast("bigint").alias("files"),
    )
    told = summary.select(
        F.lit("exporter").alias("kind"), "exporter", F.col("latest_partition").alias("partition_value"), "partition_type",
        F.lit(None).cast("string").alias("s3_key"), F.col("earliest_partition").alias("file_name"),
        F.col("total_size_bytes").alias("file_size_bytes"), F.col("total_files").alias("files"),
    )
    return listed.unionAll(told)


@query("""
with up as (select event_type as exporter, strftime(ts, '%Y-%m-%d') as partition_value, event_id, user_id,
    event_type <> 'purchase' and day(ts) < 20 as aged from events),
newest as (select exporter, partition_value, arg_max(user_id, event_id) as row_count, arg_max(aged, event_id) as aged, max(event_id) as event_seq
  from up group by all)
select exporter, partition_value, cast(row_count as bigint) as row_count, event_seq,
  case when not aged then 'completed' end as status, case when not aged then cast(row_count as bigint) end as file_size from newest
""")
def ledger_schemas(t: Tables):
    # files from before there were status and size, with narrower numbers and a column since dropped; read, and rewritten as few
    rows = t.events.select(
        F.col("event_type").alias("exporter"), day().alias("partition_value"), F.col("user_id").cast("int").alias("row_count"),
        F.col("event_id").alias("event_seq"), ((F.col("event_type") != "purchase") & (F.dayofmonth("ts") < 20)).alias("aged"),
    )
    root = new_dir(t.spark, "ledger")
    ledger = Ledger(t.spark, root)
    ledger.append("uploads", rows.where("not aged").withColumns({"file_size": F.col("row_count"), "status": F.lit("completed")}))
    old = rows.where("aged").select("event_seq", "exporter", "partition_value", "row_count", F.lit("x").alias("checksum"))
    old.write.mode("append").parquet(ledger.folder("uploads"))
    columns = ["exporter", "partition_value", "row_count", "event_seq", "status", "file_size"]
    before = materialise(ledger.uploads().select(*columns), "before")
    ledger.compact("uploads")
    after = ledger.uploads().select(*columns)
    # a difference would show as rows more
    return after.unionAll(after.exceptAll(before)).unionAll(before.exceptAll(after))


@query("""
select 'events' as exporter, 'by name' as chosen, count(distinct strftime(ts, '%Y-%m-%d')) as uploaded, cast(0 as bigint) as skipped_existing from events
union all select 'orders', 'by group', count(distinct year(o_orderdate)), 0 from orders
union all select 'events', 'by both names', 0, count(distinct strftime(ts, '%Y-%m-%d')) from events
union all select 'orders', 'by both names', 0, count(distinct year(o_orderdate)) from orders
union all select 'parts', 'refused', 0, 0
""")
def publish_by_selection(t: Tables):
    # one dataset by its name, one by its group, then both, which have nothing left to do; a name that there isn't stops all
    orders = t.orders.withColumn("partition_value", F.year("o_orderdate").cast("string"))
    yearly = DatasetSpec("orders", "orders", "o_year", EPOCH, "yearly")
    ledger, target = Ledger(t.spark, new_dir(t.spark, "ledger")), new_dir(t.spark, "published")
    jobs = {
        "events": (PublishJob(_land_events(t), target, ledger), Truth(t.events, t.events, "event_id", day())),
        "orders": (PublishJob(_land(orders, yearly), target, ledger), Truth(t.orders.select(F.year("o_orderdate").alias("o_year")))),
    }
    specs = [_EVENTS, yearly]

    def chosen(label: str, **choice):
        summary = publish_all(t.spark, jobs, specs, _NOW, **choice)
        return materialise(summary.select("exporter", F.lit(label).alias("chosen"), "uploaded", "skipped_existing"), "chosen")

    refused = []
    try:
        chosen("unknown", names=["events", "parts"])
    except ValueError as error:
        refused.append((str(error).rsplit(" ", 1)[1], "refused", 0, 0))
    found = chosen("by name", names=["events"]).unionAll(chosen("by group", group="yearly")).unionAll(chosen("by both names", names=["orders", "events"]))
    return found.unionAll(t.spark.createDataFrame(refused, found.schema))


@query("""
select 'file' as kind, cast(s_suppkey as varchar) as name, s_name as title, true as success from supplier
union all select 'response', cast(c_custkey as varchar), case when c_acctbal >= 0 then c_name end, c_acctbal >= 0 from customer
""")
def landed_documents(t: Tables):
    # a text file for each supplier, and answers landed in two deliveries, read back from disk
    files, answers = new_dir(t.spark, "files"), new_dir(t.spark, "answers")
    document = F.to_json(F.struct(F.col("s_name").alias("title")))
    write_documents(t.supplier.select(F.col("s_suppkey"), document.alias("value")), files)
    read = read_documents(t.spark, files, "*.txt")
    listed = read.select(
        F.lit("file").alias("kind"), F.regexp_extract("path", r"^s_suppkey=([^/]+?)(?:\.txt|/[^/]+)$", 1).alias("name"),
        F.get_json_object("content", "$.title").alias("title"), F.lit(True).alias("success"),
    )
    solvent, key = F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")
    body = F.struct(key.alias("pool_id"), F.when(solvent, F.col("c_mktsegment")).alias("ticker"), F.when(solvent, F.col("c_name")).alias("name"))
    landed = t.customer.select(
        key.alias("id"), F.lit(200).alias("http_status"), F.to_json(body).alias("body"),
        F.lit(None).cast("string").alias("transport_error"), F.lit(_NOW).alias("fetched_at"), solvent.alias("first"),
    )
    for n, part in enumerate((F.col("first"), ~F.col("first"))):
        landed.where(part).drop("first").write.parquet(f"{answers}/delivery={n}")
    resolved = resolve_pools(read_responses(t.spark, answers))
    return listed.unionAll(resolved.select(F.lit("response"), F.col("id"), F.col("name"), F.col("success")))
