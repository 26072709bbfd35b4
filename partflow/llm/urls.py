"""URL filter: rules by host and path, then a weighted vocabulary searched by Aho-Corasick."""

from __future__ import annotations

import functools
import string
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Host, path, verdict. A rule fits its host and all subdomains where the path starts with its path.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: One of these rejects an address.
STRICT = ("casino", "porn", "xxx", "viagra", "escort", "camgirl", "warez", "torrents")
#: Several different ones of these do.
SOFT = ("cheap", "pills", "free", "win", "adult", "bonus", "poker", "slots", "loan", "betting", "replica", "hot", "dating", "lottery")
SOFT_NEEDED = 2

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_INSIDE = frozenset(string.ascii_lowercase + string.digits)


@functools.lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in ((1, soft), (0, strict)):  # a term in both lists is strict
        for term in terms:
            found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def term_hits(url: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """How many different strict and soft terms stand in an address between characters other than letters and digits."""
    text = url.translate(_LOWER)
    hits: tuple[set, set] = (set(), set())
    for end, (term, weight) in _automaton(strict, soft).iter(text):
        start = end - len(term) + 1
        if (start == 0 or text[start - 1] not in _INSIDE) and (end + 1 == len(text) or text[end + 1] not in _INSIDE):
            hits[weight].add(term)
    return len(hits[0]), len(hits[1])


def _fit(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    return ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_needed: int = SOFT_NEEDED,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``key, host, path, rule, n_strict, n_soft, verdict`` of every row.

    The longest fitting rule decides (rules of equal length: the first given); without
    one, an address is blocked for one strict term or ``soft_needed`` different soft
    ones. A null address, or one without ``://``, has an empty host and path, fits no
    rule, and is judged by its terms (null: none, so it is allowed). Repeated rows are
    judged each; further columns are ignored; an empty table gives no rows.
    """
    strict, soft = tuple(strict), tuple(soft)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [term_hits(u or "", strict, soft) for u in batch.column("url").to_pylist()]
            arrays = [*batch.columns, pa.array([h[0] for h in hits], pa.int32()), pa.array([h[1] for h in hits], pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "url", "n_strict", "n_soft"])

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).mapInArrow(run, f"key {kind}, url string, n_strict int, n_soft int")
    part = lambda pattern: F.coalesce(F.regexp_extract("url", pattern, 1), F.lit(""))
    host = F.translate(part(r"(?s)\A.*?://([^/?#]*)"), string.ascii_uppercase, string.ascii_lowercase)
    rows = rows.withColumns({"host": host, "path": part(r"(?s)\A.*?://[^/?#]*([^?#]*)")})
    by_length = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(by_length):
        fits = _fit(F.col("host"), F.col("path"), r)
        rule, decided = F.when(fits, r[0] + r[1]).otherwise(rule), F.when(fits, r[2]).otherwise(decided)
    bad = (F.col("n_strict") > 0) | (F.col("n_soft") >= soft_needed)
    verdict = F.coalesce(decided, F.when(bad, "block").otherwise("allow"))
    return rows.select(F.col("key").alias(key), "host", "path", rule.alias("rule"), "n_strict", "n_soft", verdict.alias("verdict"))


def judge_sql(strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_needed: int = SOFT_NEEDED) -> str:
    """The same for ``pages`` under ``RULES`` as SQL."""
    low = f"translate(coalesce(url, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    count = lambda terms: " + ".join(f"regexp_matches({low}, '(^|[^a-z0-9]){t}([^a-z0-9]|$)', 's')::INT" for t in terms)
    by_length = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda r: f"(host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}')"
    rule = " ".join(f"WHEN {fits(r)} THEN '{r[0]}{r[1]}'" for r in by_length)
    decided = " ".join(f"WHEN {fits(r)} THEN '{r[2]}'" for r in by_length)
    return f"""
    WITH parts AS (
        SELECT page_id, url,
            translate(coalesce(regexp_extract(url, '\\A.*?://([^/?#]*)', 1, 's'), ''),
                '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
            coalesce(regexp_extract(url, '\\A.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
            ({count(strict)})::INT AS n_strict, ({count(soft)})::INT AS n_soft
        FROM pages
    )
    SELECT page_id, host, path, CASE {rule} END AS rule, n_strict, n_soft,
        CASE {decided} WHEN n_strict > 0 OR n_soft >= {soft_needed} THEN 'block' ELSE 'allow' END AS verdict
    FROM parts
    """
