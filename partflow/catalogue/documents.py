"""Landed JSON: answers of services and registry files."""

from __future__ import annotations

from pyspark.sql import functions as F

from partflow.catalogue.entries import Tables, query
from partflow.functions.documents import resolve_pools, resolve_profiles, response_error
from partflow.operators import registry


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_payload_extract(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("""
select event_id,
  case when value > 100 then null when event_type = 'signup' then 'n' || event_id when event_type = 'view' then 'Top' when event_type = 'purchase' then 'padded' end as drep_name,
  coalesce(value <= 100 and event_type in ('signup', 'view', 'purchase'), false) as success,
  case when value > 100 or event_type in ('click', 'error') then 'no givenName in metadata' end as error
from events
""")
def json_name_extract(t: Tables):
    # by type: a name in the body; an empty one with another above; none; a
    # number; a padded one. Large events carry a blank that hides the one above.
    kind = F.col("event_type")
    document = (
        F.when(F.col("value") > 100, '{"json_metadata": {"givenName": "Top", "body": {"givenName": "  "}}}')
        .when(kind == "signup", F.format_string('{"json_metadata": {"body": {"givenName": "n%d"}}}', "event_id"))
        .when(kind == "view", '{"json_metadata": {"givenName": "Top", "body": {"givenName": ""}}}')
        .when(kind == "click", '{"json_metadata": {"body": {}}}')
        .when(kind == "error", F.format_string('{"json_metadata": {"body": {"givenName": %d}}}', F.col("event_id") + 1))
        .otherwise('{"json_metadata": {"body": {"givenName": " \\t padded\\n"}}}')
    )
    responses = t.events.select(
        "event_id", F.lit(200).alias("http_status"), document.alias("body"), F.lit(None).cast("string").alias("transport_error")
    )
    return resolve_profiles(responses).select("event_id", "drep_name", "success", "error")


@query("""
select event_id, case event_type when 'click' then 'no metadata' when 'view' then 'rate limited' when 'error' then 'HTTP ' || (500 + user_id)
  when 'purchase' then case when value > 50 then 'timeout' else 'no response' end end as error from events
""")
def response_classify(t: Tables):
    kind = F.col("event_type")
    status = F.when(kind == "signup", 200).when(kind == "click", 404).when(kind == "view", 429).when(kind == "error", F.col("user_id") + 500)
    transport = F.when((kind == "purchase") & (F.col("value") > 50), "timeout")
    return t.events.select("event_id", response_error(status, transport).alias("error"))


@query("""
select c_custkey, case when c_acctbal >= 0 then c_mktsegment else '' end as ticker, case when c_acctbal >= 0 then c_name end as name,
  'pool' || c_custkey as pool_id, 'https://p/' || c_custkey as metadata_url, c_acctbal >= 0 as success,
  case when c_acctbal < 0 then 'no ticker or name in metadata' end as error from customer
""")
def pool_document_extract(t: Tables):
    solvent = F.col("c_acctbal") >= 0
    key = F.col("c_custkey").cast("string")
    document = F.struct(
        F.concat(F.lit("pool"), key).alias("pool_id"),
        F.when(solvent, F.col("c_mktsegment")).otherwise("").alias("ticker"),
        F.when(solvent, F.col("c_name")).alias("name"),
        F.concat(F.lit("https://p/"), key).alias("url"),
    )
    responses = t.customer.select(
        "c_custkey", F.lit(200).alias("http_status"), F.to_json(document).alias("body"), F.lit(None).cast("string").alias("transport_error")
    )
    return resolve_pools(responses).select("c_custkey", "ticker", "name", "pool_id", "metadata_url", "success", "error")


# A registry file describes few contracts, so suppliers are dealt out over files
# of at most this many; no group grows with the data.
_PER_FILE = 50


def _suppliers(t: Tables):
    bucket = F.expr(f"s_suppkey div {_PER_FILE}")
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = t.supplier.select("s_suppkey", "s_name", "s_nationkey").distinct()
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("bucket", bucket)


def _contract(kind: str):
    return F.struct(
        F.col("s_suppkey").cast("string").alias("scriptHash"),
        F.col("s_name").alias("name"),
        F.lit("Plutus").alias(kind),
        F.lit("spend").alias("purpose"),
    )


def _as_file(project: str, items: str, *group: str):
    document = F.struct(F.col("n_name").alias(project), F.lit("DeFi").alias("category"), F.col(items))
    path = F.concat_ws("/", *group)
    return path.alias("path"), F.to_json(document).alias("content")


_FLAT_SQL = """
select cast(s_suppkey as varchar) as script_hash, n_name as project_name, s_name as contract_name, 'DeFi' as category, '' as sub_category,
  'spend' as purpose, 'Plutus' as language, '{source}' as source
from (select distinct s_suppkey, s_name, s_nationkey from supplier) join nation on s_nationkey = n_nationkey
"""


@query(_FLAT_SQL.format(source="stricahq"))
def registry_parse_contracts(t: Tables):
    grouped = _suppliers(t).groupBy("n_name", "bucket").agg(F.collect_list(_contract("language")).alias("contracts"))
    files = grouped.select(*_as_file("projectName", "contracts", "n_name", "bucket"))
    return registry.parse_contracts(files).drop("path")


@query(_FLAT_SQL.format(source="crfa_v2"))
def registry_parse_scripts(t: Tables):
    grouped = _suppliers(t).groupBy("n_name", "bucket").agg(F.collect_list(_contract("type")).alias("scripts"))
    files = grouped.select(*_as_file("dAppName", "scripts", "n_name", "bucket"))
    return registry.parse_scripts(files).drop("path")


@query("""
select cast(s_suppkey as varchar) as script_hash, r_name as project_name, n_name as contract_name, 'crfa_v1' as source
from (select distinct s_suppkey, s_name, s_nationkey from supplier) join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def registry_parse_versions(t: Tables):
    version = F.struct(F.col("s_suppkey").cast("string").alias("scriptHash"))
    scripts = _suppliers(t).groupBy("r_name", "bucket", "n_name").agg(F.collect_list(version).alias("versions"))
    script = F.struct(F.col("n_name").alias("name"), F.lit("Plutus").alias("type"), F.lit("spend").alias("purpose"), "versions")
    grouped = scripts.groupBy("r_name", "bucket").agg(F.collect_list(script).alias("scripts"))
    document = F.struct(F.col("r_name").alias("dAppName"), "scripts")
    files = grouped.select(F.concat_ws("/", "r_name", "bucket").alias("path"), F.to_json(document).alias("content"))
    return registry.parse_versioned_scripts(files).select("script_hash", "project_name", "contract_name", "source")


@query("""
select page_id, 'en/' || page_id || '.json' as filename from pages
where split_part(url, '/', 4) = 'en' and not contains(url, '.html') and not contains(url, '#')
""")
def changed_files(t: Tables):
    url = F.col("url")
    suffix = F.when(url.contains(".html"), ".md").otherwise(".json")
    name = F.concat(F.split_part(url, F.lit("/"), F.lit(4)), F.lit("/"), "page_id", suffix)
    status = F.when(url.contains("#"), "removed").otherwise("modified")
    changes = t.pages.select("page_id", name.alias("filename"), status.alias("status"))
    return registry.changed_files(changes, "en/").select("page_id", "filename")
