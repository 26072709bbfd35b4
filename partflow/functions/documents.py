"""Landed service answers as columns.

A response row carries ``http_status``, ``body`` and ``transport_error`` (why
there is no status). Each function takes the frame, not a column, so the parsed
document is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.text import has_text, strip

# Outcome texts that consumers of the results know.
NO_METADATA = "no metadata"
RATE_LIMITED = "rate limited"
NO_GIVEN_NAME = "no givenName in metadata"
NO_TICKER_OR_NAME = "no ticker or name in metadata"
NO_RESPONSE = "no response"
BAD_DOCUMENT = "invalid JSON document"

# JSON texts of the values that count as absent: null, "", zero, false, [] and {}.
_EMPTY_JSON = r'^(null|""|-?0+(\.0*)?([eE][+-]?[0-9]+)?|false|\[\]|\{\})$'


def response_error(http_status: Column, transport_error: Column) -> Column:
    """Why a request failed, or null for status 200."""
    return (
        F.when(http_status.isNull(), F.coalesce(transport_error, F.lit(NO_RESPONSE)))
        .when(http_status == 404, NO_METADATA)
        .when(http_status == 429, RATE_LIMITED)
        .when(http_status != 200, F.concat(F.lit("HTTP "), http_status.cast("string")))
    )


def _document(responses: DataFrame) -> DataFrame:
    """Add ``_error`` and ``_doc``; an answer that is not a JSON object is an error."""
    parsed = responses.withColumn("_doc", F.try_parse_json("body"))
    # a text that parses is an object if it begins like one; its schema need not be derived
    is_object = F.col("_doc").isNotNull() & F.coalesce(F.ltrim("body").rlike(r"^[\s]*\{"), F.lit(False))
    failed = response_error(F.col("http_status"), F.col("transport_error"))
    return parsed.withColumn("_error", F.when(failed.isNotNull(), failed).when(~is_object, BAD_DOCUMENT))


def _text_at(path: str) -> Column:
    return F.try_variant_get("_doc", path, "string")


def _given_name() -> Column:
    """Name in the document body, else the top-level one.

    Any body value that counts as present hides the top-level one, even if it is
    no text or blank.
    """
    inner = F.try_variant_get("_doc", "$.json_metadata.body.givenName", "variant")
    outer = F.try_variant_get("_doc", "$.json_metadata.givenName", "variant")
    inner_absent = F.coalesce(F.to_json(inner).rlike(_EMPTY_JSON), F.lit(True))
    return F.when(inner_absent, outer).otherwise(inner)


def resolve_profiles(responses: DataFrame) -> DataFrame:
    """Add ``anchor_url``, ``drep_name``, ``success`` and ``error`` to profile responses.

    Only a name that is a text, and not blank, is one. Each step is a column of
    its own, so that nothing is taken out of the document twice.
    """
    answered = F.col("_error").isNull()
    has_url = F.try_variant_get("_doc", "$.url", "variant").isNotNull()
    is_name = (F.schema_of_variant("_name") == "STRING") & has_text(F.col("_text"))
    return (
        _document(responses)
        .withColumn("_name", F.when(answered, _given_name()))
        .withColumn("_text", F.try_variant_get("_name", "$", "string"))
        .withColumn("drep_name", F.when(is_name, strip(F.col("_text"))))
        .withColumn("anchor_url", F.when(answered & has_url, _text_at("$.url")).otherwise(""))
        .withColumn("success", F.col("drep_name").isNotNull())
        .withColumn("error", F.when(~F.col("success"), F.coalesce("_error", F.lit(NO_GIVEN_NAME))))
        .drop("_doc", "_error", "_name", "_text")
    )


# Output column <- member of the pool document.
POOL_MEMBERS = {
    "pool_id": "pool_id",
    "ticker": "ticker",
    "name": "name",
    "description": "description",
    "homepage": "homepage",
    "metadata_url": "url",
    "metadata_hash": "hash",
}


def resolve_pools(responses: DataFrame) -> DataFrame:
    """Add the pool attributes, ``success`` and ``error`` to pool responses."""
    answered = F.col("_error").isNull()
    filled = lambda name: F.coalesce(F.length(name) > 0, F.lit(False))
    return (
        _document(responses)
        .withColumns({out: F.when(answered, _text_at(f"$.{member}")) for out, member in POOL_MEMBERS.items()})
        .withColumn("success", filled("ticker") | filled("name"))
        .withColumn("error", F.when(~F.col("success"), F.coalesce("_error", F.lit(NO_TICKER_OR_NAME))))
        .drop("_doc", "_error")
    )
