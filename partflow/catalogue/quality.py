"""Reconciliation, measures and the publish gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from partflow.catalogue.entries import Tables, day, event_partitions, query
from partflow.operators import ledger, measures, reconcile, selection
from partflow.operators.assets import clean_assets
from partflow.operators.keyed import remove_keys
from partflow.operators.stats import partition_stats, truth_day_bounds, truth_epoch_counts
from partflow.scratch import materialise

# The export as it went wrong: two days without their error events, one day's
# first hour filed a day early, one day's first signups too, and the first day
# filed under a date the truth does not know.
_EXPORT_SQL = """
ex as (select event_id, strftime(case
    when cast(ts as date) = date '2024-01-01' then ts - interval 1 day
    when cast(ts as date) = date '2024-01-12' and hour(ts) = 0 and event_type = 'signup' then ts - interval 1 day
    when cast(ts as date) = date '2024-01-17' and hour(ts) = 0 then ts - interval 1 day
    else ts end, '%Y-%m-%d') p
  from events where not (event_type = 'error' and cast(ts as date) in (date '2024-01-09', date '2024-01-23')))
"""


def _export(t: Tables):
    filed, kind = F.col("ts").cast("date"), F.col("event_type")
    early = (
        (filed == "2024-01-01")
        | ((filed == "2024-01-12") & (F.hour("ts") == 0) & (kind == "signup"))
        | ((filed == "2024-01-17") & (F.hour("ts") == 0))
    )
    value = F.when(early, F.date_sub(filed, 1)).otherwise(filed).cast("string")
    lost = (kind == "error") & filed.cast("string").isin("2024-01-09", "2024-01-23")
    return t.events.where(~lost).select("event_id", value.alias("partition_value"))


@query(f"""
with {_EXPORT_SQL},
pq as (select p, count(*) n, min(event_id) lo, max(event_id) hi from ex group by 1),
blk as (select strftime(ts, '%Y-%m-%d') p, min(event_id) blo, max(event_id) bhi from events group by 1),
cnt as (select pq.p, count(e.event_id) c from pq left join events e on e.event_id between pq.lo and pq.hi group by 1)
select pq.p as partition_value, n as pq_count, case when blo is not null then c end as pg_count,
  lo as pq_min_slot, hi as pq_max_slot, blo as pg_min_slot, bhi as pg_max_slot,
  coalesce(blo is not null and n = c and lo >= blo and hi <= bhi, false) as is_valid,
  case when blo is null then 'No blocks found in PG for date ' || pq.p
    else nullif(concat_ws('; ',
      case when n <> c then 'Row count mismatch: parquet=' || n || ', pg=' || c end,
      case when lo < blo or hi > bhi then 'Slot range outside block range: pq=[' || lo || ',' || hi
        || '], blocks=[' || blo || ',' || bhi || ']' end), '') end as error_details
from pq left join blk on pq.p = blk.p join cnt on cnt.p = pq.p
""")
def reconcile_daily(t: Tables):
    stats = partition_stats(_export(t), F.col("partition_value"), F.col("event_id"))
    bounds = truth_day_bounds(t.events, day(), F.col("event_id"))
    return reconcile.reconcile_daily(materialise(stats, "stats"), t.events, F.col("event_id"), bounds)


# One flag's rows of two years are lost; one quantity's rows of a year are filed
# under a year the truth does not know.
_EPOCH_EXPORT_SQL = """
pq as (select case when year(l_shipdate) = 1998 and l_quantity = 50 then 2098 else year(l_shipdate) end e, count(*) n
  from lineitem where not (l_returnflag = 'R' and year(l_shipdate) in (1996, 1999)) group by 1),
pg as (select year(l_shipdate) e, count(*) n from lineitem group by 1)
"""


def _epoch_stats(t: Tables):
    year = F.year("l_shipdate")
    lost = (F.col("l_returnflag") == "R") & year.isin(1996, 1999)
    filed = F.when((year == 1998) & (F.col("l_quantity") == 50), 2098).otherwise(year)
    return partition_stats(t.lineitem.where(~lost), filed.cast("string"))


@query(f"""
with {_EPOCH_EXPORT_SQL}
select cast(pq.e as varchar) as partition_value, pq.n as pq_count, coalesce(pg.n, 0) as pg_count,
  pq.n = coalesce(pg.n, 0) as is_valid,
  case when pq.n <> coalesce(pg.n, 0) then 'Row count mismatch: parquet=' || pq.n || ', pg=' || coalesce(pg.n, 0) end
    as error_details
from pq left join pg on pq.e = pg.e
""")
def reconcile_epoch(t: Tables):
    return reconcile.reconcile_epoch(_epoch_stats(t), truth_epoch_counts(t.lineitem, F.year("l_shipdate")))


@query("""
with pq as (select distinct year(l_shipdate) e from lineitem)
select cast(year(o_orderdate) as varchar) as partition_value, count(*) as pg_count from orders
where year(o_orderdate) not in (select e from pq) or year(o_orderdate) = 1995 group by 1
""")
def missing_epochs(t: Tables):
    # the export lacks a year that the truth has
    exported = t.lineitem.where(F.year("l_shipdate") != 1995)
    stats = partition_stats(exported, F.year("l_shipdate").cast("string"))
    return reconcile.missing_epochs(stats, truth_epoch_counts(t.orders, F.year("o_orderdate")))


@query("""
with parts as (select event_type x, strftime(ts, '%Y-%m-%d') p, count(*) n, max(value) > 300 bad from events group by 1, 2)
select x as exporter, p as partition_value, n as row_count from parts where not bad
""")
def publish_gate(t: Tables):
    events = event_partitions(t)
    stats = partition_stats(events, F.col("partition_value"), by=["exporter"])
    return remove_keys(stats, events.where("value > 300"), selection.PARTITION_KEY)


@query("""
with parts as (select event_type x, strftime(ts, '%Y-%m-%d') p, count(*) n from events group by 1, 2)
select x as exporter, count(*) as scanned,
  count(*) filter (where p < '2024-01-11') as skipped_existing,
  count(*) filter (where p >= '2024-01-11') as validated,
  count(*) filter (where p >= '2024-01-11' and bad) as validation_errors,
  count(*) filter (where p >= '2024-01-11' and not bad) as uploaded,
  cast(0 as bigint) as upload_errors
from (select parts.*, exists (select 1 from events e where e.event_type = x and strftime(e.ts, '%Y-%m-%d') = p and e.value > 250) bad
  from parts) group by 1
""")
def run_summary(t: Tables):
    parts = event_partitions(t).groupBy("exporter", "partition_value").agg(F.max("value").alias("highest"))
    skipped = F.col("partition_value") < "2024-01-11"
    outcome = F.when(skipped, "skipped").when(F.col("highest") > 250, "invalid").otherwise("uploaded")
    return ledger.run_summary(parts.withColumn("outcome", outcome).withColumn("was_validated", ~skipped))


# Orders as one-row epochs. The authority lacks low-priority orders in progress,
# differs in the treasury of urgent ones, has no fees for medium ones, and
# publishes texts.
_MEASURES_SQL = """
own as (select o_orderkey k, o_orderstatus st, o_orderpriority pr, o_custkey treasury,
    cast(round(o_totalprice * 100) as bigint) reserves, cast(year(o_orderdate) as bigint) fees,
    o_custkey + o_orderkey deposits_stake from orders),
auth as (select k, treasury + case when pr = '1-URGENT' then 1 else 0 end treasury, reserves,
    case when pr = '3-MEDIUM' then 0 else fees end fees, deposits_stake
  from own where not (st = 'P' and pr = '5-LOW'))
"""


def _export_measures(t: Tables):
    pot = F.round(F.col("o_totalprice") * 100).cast("bigint")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return t.orders.select(
        F.col("o_orderkey").alias("epoch"),
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_custkey").alias("treasury"),
        pot.alias("reserves"),
        F.year("o_orderdate").cast("bigint").alias("fees"),
        (F.col("o_custkey") + F.col("o_orderkey")).alias("deposits_stake"),
        pot.alias("rewards_pot"),
        (pot - F.floor(pot / 5) + F.when(urgent, 1).otherwise(0)).alias("pool_rewards_pot"),
    )


def _authority(own):
    priority = F.col("o_orderpriority")
    known = own.where(~((F.col("o_orderstatus") == "P") & (priority == "5-LOW")))
    return known.select(
        "epoch",
        (F.col("treasury") + F.when(priority == "1-URGENT", 1).otherwise(0)).cast("string").alias("treasury"),
        F.col("reserves").cast("string").alias("reserves"),
        F.when(priority != "3-MEDIUM", F.col("fees").cast("string")).alias("fees"),
        F.col("deposits_stake").cast("string").alias("deposits_stake"),
    )


@query(f"""
with {_MEASURES_SQL},
pairs as (
  select own.k, 'treasury' field, own.treasury parquet, auth.treasury authority, auth.k is not null av from own left join auth on own.k = auth.k
  union all select own.k, 'reserves', own.reserves, auth.reserves, auth.k is not null from own left join auth on own.k = auth.k
  union all select own.k, 'fees', own.fees, auth.fees, auth.k is not null from own left join auth on own.k = auth.k
  union all select own.k, 'deposits_stake', own.deposits_stake, auth.deposits_stake, auth.k is not null from own left join auth on own.k = auth.k)
select k as epoch, field, parquet, authority, av as authority_available, coalesce(av and parquet = authority, false) as is_match from pairs
""")
def measure_compare(t: Tables):
    own = _export_measures(t)
    return measures.compare_measures(own, _authority(own), "epoch")


@query(f"""
with {_MEASURES_SQL},
j as (select own.*, auth.k is not null av, auth.treasury treasury_at, auth.fees fees_at,
    own.reserves pot, own.reserves - own.reserves // 5 expected, own.reserves - own.reserves // 5 + case when own.pr = '1-URGENT' then 1 else 0 end share
  from own left join auth on own.k = auth.k),
r as (select k as epoch, av as authority_available,
  case when not av then 'authority unavailable' else nullif(concat_ws(', ',
    case when treasury <> treasury_at then 'treasury: parquet=' || treasury || ' authority=' || treasury_at end,
    case when fees <> fees_at then 'fees: parquet=' || fees || ' authority=' || fees_at end,
    case when pot > 0 and share <> expected then 'pool_ratio: got=' || share || ' expected=' || expected end), '') end as error_details
  from j)
select epoch, authority_available, error_details is null as all_pass, error_details from r where error_details is not null
""")
def measure_mismatches(t: Tables):
    own = _export_measures(t)
    return measures.measure_report(own, _authority(own), "epoch").where(~F.col("all_pass"))


@query("""
with p as (select o_orderkey k, o_orderpriority pr, cast(round(o_totalprice * 100) as bigint) pot from orders)
select k as epoch, pot as rewards_pot, pot - pot // 5 + (case when pr = '1-URGENT' then 1 else 0 end) as pool_rewards_pot,
  pot - pot // 5 as expected_pool, pr <> '1-URGENT' as is_match from p where pot > 0
""")
def measure_split_check(t: Tables):
    own = _export_measures(t).select("epoch", "rewards_pot", "pool_rewards_pot")
    return measures.check_split(own)


@query(f"""
with {_MEASURES_SQL}
select own.k as epoch, coalesce(auth.treasury, 0) as treasury, coalesce(auth.reserves, 0) as reserves,
  coalesce(auth.fees, 0) as fees, coalesce(auth.deposits_stake, 0) as deposits_stake, own.reserves as rewards_pot
from own left join auth on own.k = auth.k
""")
def measure_correct(t: Tables):
    own = _export_measures(t)
    columns = ["epoch", *measures.MEASURES, "rewards_pot"]
    return measures.correct_measures(own.select(*columns), _authority(own), "epoch")


@query("""
select p_partkey, p_type as category, coalesce(nullif(case when p_size > 25 then '' when p_size > 10 then p_brand end, ''), p_name) as ticker
from part where not (p_name like 'hot %' and p_type = 'ECONOMY')
""")
def asset_clean(t: Tables):
    size = F.col("p_size")
    assets = t.part.select(
        "p_partkey",
        F.when(size > 25, "").when(size > 10, F.col("p_brand")).alias("ticker"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_name").startswith("hot ").alias("is_meme"),
    )
    return clean_assets(assets, "ECONOMY").select("p_partkey", "category", "ticker")
