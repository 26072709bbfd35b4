"""Latest profile per key, merged so that a failure never replaces a success."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.documents import NO_RESPONSE, resolve_profiles
from partflow.functions.text import has_text
from partflow.operators.keyed import newest_per_key
from partflow.spec import PROFILE_SCHEMA

SUCCESS = "success"
FAILED = "failed"
NO_URL = "no_url"

UNCHANGED = "unchanged"
TO_RESOLVE = "to_resolve"


def newest_registrations(registrations: DataFrame) -> DataFrame:
    """Newest registration per ``drep_id``, and whether any of them has a URL.

    Equal blocks are decided by slot, then by transaction.
    """
    return newest_per_key(
        registrations,
        ["drep_id"],
        ["block", "slot", "tx_hash"],
        F.bool_or(has_text(F.col("anchor_url"))).alias("has_url"),
    )


def _action(existing_block, newest_block, has_url):
    stale = existing_block.isNotNull() & F.coalesce(newest_block <= existing_block, F.lit(False))
    return F.when(stale, UNCHANGED).when(~has_url, NO_URL).otherwise(TO_RESOLVE)


def classify(newest: DataFrame, existing: DataFrame) -> DataFrame:
    """What to do about every registered key: ``action`` beside its newest block.

    The keys to resolve are what a fetcher has to ask for.
    """
    held = existing.select("drep_id", F.col("source_block").alias("existing_block"))
    return newest.join(held, "drep_id", "left").select(
        "drep_id",
        F.col("block").alias("newest_block"),
        _action(F.col("existing_block"), F.col("block"), F.col("has_url")).alias("action"),
    )


def answered_batch(newest: DataFrame, responses: DataFrame) -> DataFrame:
    """Newest registrations with what the landed responses say about their keys.

    The response replaces the registered URL. Only the documents of keys in the
    batch are parsed.
    """
    return resolve_profiles(join_responses(newest.drop("anchor_url"), responses, "drep_id"))


def merge_profiles(existing: DataFrame, batch: DataFrame, now: str) -> DataFrame:
    """The profile after one batch, as ``answered_batch`` gives it.

    A key without a response counts as failed. A kept success only has its check
    time moved, so its block does not advance and the key is tried again next
    time. Keys outside the batch pass through.
    """
    old, new = F.struct(*PROFILE_SCHEMA.names), F.struct(*[c for c in batch.columns if c != "drep_id"])
    both = existing.select("drep_id", old.alias("old")).join(
        batch.select("drep_id", new.alias("new")), "drep_id", "full_outer"
    )

    action = _action(F.col("old.source_block"), F.col("new.block"), F.col("new.has_url"))
    pass_through = F.col("new").isNull() | (action == UNCHANGED)
    no_url = action == NO_URL
    resolved = ~no_url & F.coalesce(F.col("new.success"), F.lit(False))
    keep_success = F.coalesce(F.col("old.fetch_status") == SUCCESS, F.lit(False))

    def written(status: str, url, name, http_status):
        values = {
            "drep_id": F.col("drep_id"),
            "drep_hash": F.col("new.drep_hash"),
            "anchor_url": url,
            "anchor_hash": F.col("new.anchor_hash"),
            "drep_name": name,
            "source_block": F.col("new.block"),
            "source_slot": F.col("new.slot"),
            "source_tx_hash": F.col("new.tx_hash"),
            "source_date": F.col("new.source_date"),
            "fetch_status": F.lit(status),
            "http_status": http_status,
            "last_checked_at": F.lit(now),
            "updated_at": F.lit(now),
        }
        return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in PROFILE_SCHEMA.fields])

    nothing = F.lit(None)
    row = (
        F.when(pass_through, F.col("old"))
        .when(
            resolved,
            written(SUCCESS, F.col("new.anchor_url"), F.col("new.drep_name"), F.col("new.http_status")),
        )
        .when(keep_success, F.col("old").withField("last_checked_at", F.lit(now)))
        .when(no_url, written(NO_URL, nothing, nothing, nothing))
        .otherwise(
            written(
                FAILED,
                F.coalesce("new.anchor_url", F.lit("")),
                nothing,
                F.col("new.http_status"),
            )
        )
    )
    return both.select(row.alias("row")).select("row.*")


def join_responses(ids: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """One response row per id: the one fetched last, or a transport error when none landed."""
    # only answers to these ids, and only their times, go through the reduction; of the
    # answers fetched at the last time, which are few, all columns decide
    asked = responses.join(ids.select(F.col(key).alias("id")).distinct(), "id", "left_semi")
    times = asked.groupBy("id").agg(F.max("fetched_at").alias("_last"))
    latest = asked.join(times, "id").where(F.col("fetched_at").eqNullSafe(F.col("_last"))).drop("_last")
    latest = newest_per_key(latest, ["id"], ["fetched_at"]).withColumnRenamed("id", key)
    unanswered = F.col("http_status").isNull() & F.col("transport_error").isNull()
    return ids.join(latest, key, "left").withColumn(
        "transport_error", F.when(unanswered, NO_RESPONSE).otherwise(F.col("transport_error"))
    )
