"""State per key: profiles, versions, priorities, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from partflow.catalogue.entries import Tables, day, midnight, query
from partflow.functions.documents import resolve_profiles
from partflow.operators import keyed, profile, registry, versioned
from partflow.operators.enrich import enrich, match_counts
from partflow.spec import PROFILE_SCHEMA


@query("""
select drep_id, source_block, event_type, source_date from (
  select user_id as drep_id, event_id as source_block, event_type, strftime(ts, '%Y-%m-%d') as source_date,
    row_number() over (partition by user_id order by event_id desc, event_type desc, ts desc) r from events) where r = 1
""")
def newest_per_key(t: Tables):
    rows = t.events.select(
        F.col("user_id").alias("drep_id"), F.col("event_id").alias("source_block"), "event_type", day().alias("source_date")
    )
    return keyed.newest_per_key(rows, ["drep_id"], ["source_block"])


@query("""
with old as (select user_id k, event_type s, event_id i, row_number() over (partition by user_id order by event_id, event_type) r
    from events where ts < timestamp '2024-01-03'),
inc as (select user_id k, event_type s, event_id i, row_number() over (partition by user_id order by event_id, event_type) r
    from events where ts >= timestamp '2024-01-03')
select k as script_hash, s as source, i as first_seen from old where r = 1
union all select k, s, i from inc where r = 1 and not exists (select 1 from old where old.k = inc.k)
""")
def insert_or_ignore_first_seen(t: Tables):
    rows = t.events.select(
        F.col("user_id").alias("script_hash"), F.col("event_type").alias("source"), F.col("event_id").alias("first_seen"), "ts"
    )
    start = midnight("2024-01-03")
    existing = keyed.first_per_key(rows.where(F.col("ts") < start).drop("ts"), ["script_hash"], ["first_seen"])
    return keyed.insert_or_ignore(existing, rows.where(F.col("ts") >= start).drop("ts"), ["script_hash"], ["first_seen"])


@query("""
with both_ as (select user_id k, event_id i, value v from events where event_type <> 'purchase'
  union all select user_id, event_id, value from events where event_type = 'purchase')
select k as pool_hash, i as event_seq, v as value from (select *, row_number() over (partition by k order by i desc, v desc) r from both_) where r = 1
""")
def upsert_latest(t: Tables):
    rows = t.events.select(F.col("user_id").alias("pool_hash"), F.col("event_id").alias("event_seq"), "value", "event_type")
    current = rows.where("event_type <> 'purchase'").drop("event_type")
    incoming = rows.where("event_type = 'purchase'").drop("event_type")
    return keyed.upsert(current, incoming, ["pool_hash"], ["event_seq"])


@query("""
select cast(user_id as varchar) as drep_id, bool_or(event_type = 'signup' and value > 80) as has_url, max(event_id) as block from events group by 1
""")
def any_url_per_key(t: Tables):
    return profile.newest_registrations(_registrations(t)).select("drep_id", "has_url", "block")


def _registrations(t: Tables, events=None):
    """Events as registrations of their user; only large signups bring a URL, others a blank."""
    user = F.col("user_id").cast("string")
    large = (F.col("event_type") == "signup") & (F.col("value") > 80)
    return (t.events if events is None else events).select(
        user.alias("drep_id"),
        F.concat(F.lit("hash_"), user).alias("drep_hash"),
        F.when(large, F.concat(F.lit("https://r/"), user)).otherwise(" \t").alias("anchor_url"),
        F.lit(None).cast("string").alias("anchor_hash"),
        F.col("event_id").alias("block"),
        (F.col("event_id") * 20).alias("slot"),
        F.concat(F.lit("tx_"), "event_id").alias("tx_hash"),
        day().alias("source_date"),
    )


def _existing_profile(t: Tables):
    """Profile up to the day before last of the users who ever had a large event."""
    rows = t.events.where(F.col("ts") < midnight("2024-01-30")).select(
        F.col("user_id").cast("string").alias("drep_id"), F.col("event_id").alias("source_block"), F.col("value").alias("v")
    )
    newest = keyed.newest_per_key(rows, ["drep_id"], ["source_block"], F.max("v").alias("highest"))
    user = F.col("drep_id")
    ok = F.col("v") <= 50
    values = {
        "drep_id": F.col("drep_id"),
        "source_block": F.col("source_block"),
        "anchor_url": F.when(ok, F.concat(F.lit("https://old/"), user)).otherwise(""),
        "drep_name": F.when(ok, F.concat(F.lit("old "), user)),
        "fetch_status": F.when(ok, "success").otherwise("failed"),
        "http_status": F.when(ok, 200).otherwise(404),
        "last_checked_at": F.lit("old"),
        "updated_at": F.lit("old"),
    }
    return newest.where(F.col("highest") > 150).select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PROFILE_SCHEMA.fields
        ]
    )


def _responses(t: Tables):
    """Each user's views as answers of a metadata service; large ones were not found."""
    user = F.col("user_id").cast("string")
    body = F.concat(
        F.lit('{"url": "https://new/'), user, F.lit('", "json_metadata": {"body": {"givenName": " new '), user, F.lit(' "}}}')
    )
    found = F.col("value") <= 60
    return t.events.where("event_type = 'view'").select(
        user.alias("id"),
        F.when(found, 200).otherwise(404).alias("http_status"),
        F.when(found, body).alias("body"),
        F.lit(None).cast("string").alias("transport_error"),
        F.col("event_id").alias("fetched_at"),
    )


_PROFILE_SQL = """
old as (select k, b, v from (select user_id k, event_id b, value v,
      row_number() over (partition by user_id order by event_id desc, value desc) r, max(value) over (partition by user_id) hi
    from events where strftime(ts, '%Y-%m-%d') < '2024-01-30') where r = 1 and hi > 150),
ex as (select k, b, case when v <= 50 then 'success' else 'failed' end st from old),
n as (select user_id k, max(event_id) b, bool_or(event_type = 'signup' and value > 80) has_url, max(strftime(ts, '%Y-%m-%d')) d
  from events where strftime(ts, '%Y-%m-%d') >= '2024-01-29' group by 1),
resp as (select user_id k, max(event_id) i, arg_max(value, event_id) v from events where event_type = 'view' group by 1)
"""


def _batch(t: Tables):
    return profile.newest_registrations(_registrations(t, t.events.where(F.col("ts") >= midnight("2024-01-29"))))


@query(f"""
with {_PROFILE_SQL}
select cast(n.k as varchar) as drep_id, n.b as newest_block,
  case when ex.b is not null and n.b <= ex.b then 'unchanged' when not has_url then 'no_url' else 'to_resolve' end as action
from n left join ex on n.k = ex.k
""")
def profile_classify(t: Tables):
    return profile.classify(_batch(t), _existing_profile(t))


@query(f"""
with {_PROFILE_SQL},
j as (select coalesce(ex.k, n.k) k, ex.b eb, ex.st est, n.b nb, n.d nd, resp.k is not null answered, resp.v rv,
    case when n.k is null or (ex.b is not null and n.b <= ex.b) then 'pass' when not has_url then 'no_url'
      when resp.v <= 60 then 'success' else 'failed' end a
  from ex full join n on ex.k = n.k left join resp on resp.k = n.k),
m as (select *, a = 'pass' or (a <> 'success' and coalesce(est = 'success', false)) keep from j)
select cast(k as varchar) as drep_id, case when keep then est else a end as fetch_status, case when keep then eb else nb end as source_block,
  case when keep then null else nd end as source_date,
  case when keep then case when est = 'success' then 'old ' || k end when a = 'success' then 'new ' || k end as drep_name,
  case when keep then case when est = 'success' then 'https://old/' || k else '' end
    when a = 'success' then 'https://new/' || k when a = 'failed' then '' end as anchor_url,
  cast(case when keep then case when est = 'success' then 200 else 404 end
    when a = 'success' then 200 when a = 'failed' and answered then 404 end as integer) as http_status,
  case when a = 'pass' then 'old' else 'now' end as last_checked_at,
  case when keep then 'old' else 'now' end as updated_at
from m
""")
def profile_merge(t: Tables):
    batch = profile.answered_batch(_batch(t), _responses(t))
    merged = profile.merge_profiles(_existing_profile(t), batch, "now")
    return merged.select(
        "drep_id", "fetch_status", "source_block", "source_date", "drep_name", "anchor_url", "http_status",
        "last_checked_at", "updated_at",
    )


@query("select distinct user_id as pool_hash from events")
def distinct_keys(t: Tables):
    return versioned.distinct_keys(t.events.withColumnRenamed("user_id", "pool_hash"), "pool_hash")


def _registered(t: Tables):
    return t.events.select(F.col("user_id").cast("string").alias("pool_hash"), day().alias("partition_value"))


@query("select distinct cast(user_id as varchar) as pool_hash from events where strftime(ts, '%Y-%m-%d') > '2024-01-29'")
def keys_since_watermark(t: Tables):
    return versioned.keys_since(_registered(t), "pool_hash", F.col("partition_value"), "2024-01-29")


def _exports(t: Tables):
    """Purchases of the first days as earlier exports."""
    version = F.ceil(F.col("value") / 100).cast("int")
    early = t.events.where((F.col("event_type") == "purchase") & (F.col("ts") < midnight("2024-01-05")))
    return early.select(F.col("user_id").cast("string").alias("pool_hash"), version.alias("version"), day().alias("date"))


_EXPORTS_SQL = """
exported as (select user_id k, cast(ceil(value / 100) as integer) v from events
  where event_type = 'purchase' and strftime(ts, '%Y-%m-%d') < '2024-01-05')
"""


@query("select cast(user_id as varchar) as pool_hash, max(cast(ceil(value / 100) as integer)) as max_version from events group by 1")
def max_versions(t: Tables):
    version = F.ceil(F.col("value") / 100).cast("int")
    exports = t.events.select(F.col("user_id").cast("string").alias("pool_hash"), version.alias("version"))
    return versioned.max_versions(exports, "pool_hash")


@query(f"""
with {_EXPORTS_SQL},
mv as (select k, max(v) v from exported group by 1),
due as (select distinct user_id k from events where user_id not in (select k from mv)
  union select user_id from events where strftime(ts, '%Y-%m-%d') > '2024-01-29'),
resp as (select user_id k, arg_max(value, event_id) v from events where event_type = 'view' group by 1)
select cast(due.k as varchar) as pool_hash, coalesce(mv.v, 0) + 1 as version from due join resp on resp.k = due.k and resp.v <= 60 left join mv on mv.k = due.k
""")
def versioned_increment(t: Tables):
    registered, exported = _registered(t), _exports(t)
    since = versioned.keys_since(registered, "pool_hash", F.col("partition_value"), "2024-01-29")
    due = versioned.candidates(registered, exported, since, "pool_hash")
    resolved = resolve_profiles(profile.join_responses(due, _responses(t), "pool_hash"))
    versions = versioned.max_versions(exported, "pool_hash")
    return versioned.assign_versions(resolved, versions, "pool_hash").select("pool_hash", "version")


@query("""
select event_type as exporter, max(strftime(ts, '%Y-%m-%d')) as last_day, cast(max(user_id) as varchar) as last_epoch from events group by 1
""")
def last_export_date(t: Tables):
    exports = t.events.select(F.col("event_type").alias("exporter"), day().alias("date"), F.col("user_id").alias("epoch"))
    return exports.groupBy("exporter").agg(
        versioned.last_export(F.col("date")).alias("last_day"), versioned.last_export(F.col("epoch")).alias("last_epoch")
    )


_RANK_SQL = "case source when 'stricahq' then 1 when 'crfa_v2' then 2 when 'crfa_v1' then 3 else 4 end"


@query(f"""
with records as (
  select c_custkey h, c_name n, 'stricahq' source from customer where c_acctbal > 5000
  union all select c_custkey, c_name, 'crfa_v2' from customer where c_mktsegment in ('BUILDING', 'MACHINERY')
  union all select c_custkey, c_name, 'crfa_v1' from customer)
select h as script_hash, n as contract_name, source from (
  select *, row_number() over (partition by h order by {_RANK_SQL}, n) r from records) where r = 1
""")
def priority_dedupe(t: Tables):
    records = t.customer.select(F.col("c_custkey").alias("script_hash"), F.col("c_name").alias("contract_name"), "c_acctbal", "c_mktsegment")
    first = records.where("c_acctbal > 5000").withColumn("source", F.lit("stricahq"))
    second = records.where("c_mktsegment in ('BUILDING', 'MACHINERY')").withColumn("source", F.lit("crfa_v2"))
    third = records.withColumn("source", F.lit("crfa_v1"))
    all_of_them = first.union(second).union(third).drop("c_acctbal", "c_mktsegment")
    return registry.best_source(all_of_them)


@query("select c_custkey as script_hash, 'crfa_v2' as source from customer where not c_acctbal > 8000")
def cross_run_priority(t: Tables):
    incoming = t.customer.select(F.col("c_custkey").alias("script_hash"), F.lit("crfa_v2").alias("source"))
    holder = F.when(F.col("c_acctbal") > 8000, "stricahq").when(F.col("c_acctbal") < 0, "crfa_v1")
    known = t.customer.select(F.col("c_custkey").alias("script_hash"), holder.alias("source")).dropna()
    return registry.not_outranked(incoming, known)


@query("""
with heads as (select user_id s, event_id i, strftime(ts, '%Y-%m-%d') d, value v from events),
latest as (select s, max(i) i, arg_max(v, i) v from heads group by 1),
state as (select s, max(i) i from heads where d < '2024-01-29' and v > 20 group by 1)
select latest.s as source, state.i as last_sha, latest.i as latest_sha,
  case when state.i is null then 'full' when state.i = latest.i then 'skip' when v > 100 then 'full' else 'incremental' end as mode
from latest left join state on latest.s = state.s
""")
def source_revision_changed(t: Tables):
    heads = t.events.select(F.col("user_id").alias("source"), F.col("event_id").alias("sha"), day().alias("d"), "value")
    latest = keyed.newest_per_key(heads.select("source", "sha", "value"), ["source"], ["sha"]).select(
        "source", F.col("sha").alias("latest_sha"), (F.col("value") <= 100).alias("diff_known")
    )
    state = heads.where((F.col("d") < "2024-01-29") & (F.col("value") > 20)).select(
        "source", F.col("sha").alias("last_commit_sha"), F.col("sha").alias("event_seq")
    )
    return registry.revision_plan(latest, state)


_DIM_SQL = """
dim as (select c_custkey k, c_name n, c_mktsegment u from (select *, row_number() over (partition by c_custkey
  order by c_name desc, c_mktsegment desc) r from customer where c_acctbal >= 0) where r = 1)
"""


def _enriched(t: Tables):
    profile_rows = t.customer.where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("drep_name"), F.col("c_mktsegment").alias("anchor_url")
    )
    return enrich(t.orders, profile_rows, "o_custkey", ["drep_name", "anchor_url"])


@query(f"with {_DIM_SQL} select orders.*, n as drep_name, u as anchor_url from orders left join dim on o_custkey = k")
def enrich_left_join(t: Tables):
    return _enriched(t)


@query(f"""
with {_DIM_SQL}
select cast(year(o_orderdate) as varchar) as partition_value, count(*) as total, count(n) as matched, count(*) - count(n) as unmatched
from orders left join dim on o_custkey = k group by 1
""")
def enrich_match_counts(t: Tables):
    return match_counts(_enriched(t), F.year("o_orderdate").cast("string"), "drep_name")
