"""Contract registries: parsing their files, ranking their sources, following their revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.operators.keyed import first_per_key, newest_per_key

# The sources, the best first, and where each keeps its files.
SOURCES = ("stricahq", "crfa_v2", "crfa_v1")
PREFIXES = {"stricahq": "projects/", "crfa_v2": "dApps_v2/", "crfa_v1": "dApps/"}

# Document shapes.
_CONTRACTS = (
    "projectName string, category string, subCategory string,"
    " contracts array<struct<scriptHash string, name string, language string, purpose string>>"
)
_SCRIPTS = (
    "dAppName string, category string, subCategory string,"
    " scripts array<struct<scriptHash string, name string, type string, purpose string>>"
)
_VERSIONED_SCRIPTS = (
    "dAppName string, category string, subCategory string,"
    " scripts array<struct<name string, type string, purpose string,"
    " versions array<struct<scriptHash string>>>>"
)


def _records(exploded: DataFrame, script_hash: str, project: str, language: str, source: str) -> DataFrame:
    return exploded.where(F.col(script_hash).isNotNull()).select(
        F.col(script_hash).alias("script_hash"),
        F.col(f"doc.{project}").alias("project_name"),
        F.col("item.name").alias("contract_name"),
        F.coalesce("doc.category", F.lit("")).alias("category"),
        F.coalesce("doc.subCategory", F.lit("")).alias("sub_category"),
        F.coalesce("item.purpose", F.lit("")).alias("purpose"),
        F.coalesce(language, F.lit("")).alias("language"),
        F.lit(source).alias("source"),
        "path",
    )


def _items(files: DataFrame, shape: str, member: str) -> DataFrame:
    """One row per element of ``member``; a file that is no such JSON yields none."""
    parsed = files.select("path", F.from_json("content", shape).alias("doc"))
    return parsed.withColumn("item", F.explode(f"doc.{member}"))


def parse_contracts(files: DataFrame, source: str = "stricahq") -> DataFrame:
    """Files (``path``, ``content``) with a flat list of contracts."""
    return _records(_items(files, _CONTRACTS, "contracts"), "item.scriptHash", "projectName", "item.language", source)


def parse_scripts(files: DataFrame, source: str = "crfa_v2") -> DataFrame:
    """Files with a flat list of scripts; their type is the language."""
    return _records(_items(files, _SCRIPTS, "scripts"), "item.scriptHash", "dAppName", "item.type", source)


def parse_versioned_scripts(files: DataFrame, source: str = "crfa_v1") -> DataFrame:
    """Files whose scripts hold several versions, each with a hash of its own."""
    versions = _items(files, _VERSIONED_SCRIPTS, "scripts").withColumn("version", F.explode("item.versions"))
    return _records(versions, "version.scriptHash", "dAppName", "item.type", source)


PARSERS = {"stricahq": parse_contracts, "crfa_v2": parse_scripts, "crfa_v1": parse_versioned_scripts}


def source_rank(source: Column) -> Column:
    """1 for the best source; unknown sources come last."""
    rank = F.lit(len(SOURCES) + 1)
    for position in range(len(SOURCES), 0, -1):
        rank = F.when(source == SOURCES[position - 1], position).otherwise(rank)
    return rank


def best_source(records: DataFrame, key: str = "script_hash") -> DataFrame:
    """One record per hash, from the best source that has it."""
    ranked = records.withColumn("_rank", source_rank(F.col("source")))
    return first_per_key(ranked, [key], ["_rank"]).drop("_rank")


def not_outranked(records: DataFrame, known: DataFrame, key: str = "script_hash") -> DataFrame:
    """Records whose hash is not already held by a better source."""
    held = known.groupBy(key).agg(F.min(source_rank(F.col("source"))).alias("_held"))
    outranked = F.coalesce(F.col("_held") < source_rank(F.col("source")), F.lit(False))
    return records.join(held, key, "left").where(~outranked).drop("_held")


def changed_files(changes: DataFrame, prefix: str, path: str = "filename", status: str = "status") -> DataFrame:
    """Added or modified JSON files below ``prefix``."""
    name = F.col(path)
    return changes.where(name.startswith(prefix) & name.endswith(".json") & (F.col(status) != "removed"))


def revision_plan(latest: DataFrame, state: DataFrame) -> DataFrame:
    """How to read each source: skip it, read it in full, or only its changes.

    ``latest`` holds ``source`` and ``latest_sha`` and may hold ``diff_known``;
    a source seen for the first time, or whose difference is unknown, is read in
    full. The new revision becomes the state in every case.
    """
    known = newest_per_key(state, ["source"], ["event_seq"]).select("source", F.col("last_commit_sha").alias("last_sha"))
    diff_known = F.coalesce("diff_known", F.lit(True)) if "diff_known" in latest.columns else F.lit(True)
    mode = (
        F.when(F.col("last_sha").isNull(), "full")
        .when(F.col("last_sha") == F.col("latest_sha"), "skip")
        .when(~diff_known, "full")
        .otherwise("incremental")
    )
    return latest.join(known, "source", "left").select("source", "last_sha", "latest_sha", mode.alias("mode"))
