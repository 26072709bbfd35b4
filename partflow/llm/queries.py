"""The operators of this subpackage as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm import collocations, decontaminate, ngrams, pieces, quality, repeats, simhash, surrogates, tokenfile, tokens, urls, variants, vectors
from partflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Stands for a secret that a deployment takes from its own store.
SURROGATE_KEY = "an example key"


def query(sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


@query()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    counts = tokens.count_tokens(table(spark, folder, "documents"), BYTE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query()
def op9_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as the token file gives it back."""
    return tokenfile.round_trip(table(spark, folder, "documents"), BYTE_BPE, end_id=2)


@query()
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    return simhash.simhash_groups(table(spark, folder, "documents"))


@query(
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    ), pairs AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.93
    ), reach AS (
        SELECT vec_id, vec_id AS other FROM v
        UNION
        SELECT reach.vec_id, pairs.b FROM reach JOIN pairs ON pairs.a = reach.other
    ), low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
    SELECT low.vec_id, (SELECT count(*) FROM pairs WHERE pairs.a = low.vec_id) AS n_links, component_id,
        low.vec_id = component_id AS kept
    FROM low
    """
)
def op8_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate embeddings within labels."""
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query(urls.judge_sql())
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the address of every page."""
    return urls.judge_urls(table(spark, folder, "pages"))


@query()
def op4_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), whole=True)


@query()
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents")
    scores = quality.score(docs, quality.train(docs, table(spark, folder, "labels")))
    return scores.select("doc_id", (quality.remainder(F.col("doc_id")) == 2).alias("held_out"), "score", "predicted")


@query()
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and whether decoding gives its text back."""
    return pieces.encode(table(spark, folder, "documents"), PIECE_BPE, with_text=False)


@query()
def op10_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with surrogates for personal data and secrets."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_personal_data(docs, SURROGATE_KEY)


@query(
    r"""
    WITH cut AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), words AS (
        SELECT doc_id, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS before FROM cut, unnest(range(1, len(w) + 1)) AS r(i)
    ), one AS (SELECT word, count(*) AS n FROM words GROUP BY word),
    two AS (SELECT before, word, count(*) AS n FROM words WHERE before IS NOT NULL GROUP BY before, word),
    scored AS (
        SELECT words.doc_id, CASE WHEN two.n >= 2 THEN ln(two.n / first.n)
            ELSE ln(0.4 * one.n / (SELECT sum(n) FROM one)) END AS s
        FROM words JOIN one ON words.word = one.word
        LEFT JOIN two ON words.before = two.before AND words.word = two.word
        LEFT JOIN one first ON words.before = first.word
    ), sums AS (SELECT doc_id, count(*) AS n, avg(s) AS score FROM scored GROUP BY doc_id)
    SELECT cut.doc_id, coalesce(sums.n, 0)::BIGINT AS n_words, round(sums.score, 6) AS score
    FROM cut LEFT JOIN sums ON cut.doc_id = sums.doc_id
    """
)
def op7_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Stupid-backoff score of every document under a model of all documents."""
    scores = ngrams.score_documents(table(spark, folder, "documents"))
    return scores.withColumn("score", F.round("score", 6))


@query(
    """
    WITH d AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
    ), parts AS (
        SELECT doc_id, unnest(list_transform(range(0, n - 99, 500), lambda p: {'a': p, 'm': least(500, n - 99 - p), 't': substr(h, 2 * p + 1, 1198)}),
            recursive := true) FROM d
    ), windows AS (
        SELECT doc_id, unnest(list_transform(range(0, m), lambda i: {'p': a + i, 's': substr(t, 2 * i + 1, 200)}), recursive := true) FROM parts
    ), firsts AS (
        SELECT s, min({'d': doc_id, 'p': p}) AS f FROM windows GROUP BY s HAVING count(*) > 1
    ), repeated AS (
        SELECT doc_id, p FROM windows JOIN firsts ON windows.s = firsts.s WHERE {'d': doc_id, 'p': p} <> f
    ), marked AS (
        SELECT doc_id, p, p > lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) + 100 AS opens FROM repeated
    ), numbered AS (
        SELECT doc_id, p, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
    ), runs AS (
        SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, run
    ), gaps AS (
        SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs
    ), cut AS (
        SELECT d.doc_id, sum(b - a) AS removed, count(*) AS spans,
            string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
        FROM gaps JOIN d ON d.doc_id = gaps.doc_id GROUP BY d.doc_id
    )
    SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
        sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
    """
)
def op13_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without its passages of 100 bytes that occur earlier."""
    return repeats.remove_repeats(table(spark, folder, "documents"))


@query()
def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents and the words that they are spelling variants of."""
    return variants.group_variants(table(spark, folder, "documents"))


@query(
    r"""
    WITH cut AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut),
    grams AS (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
        FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(size)
    ), counted AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
    sums AS (SELECT lang, sum(a)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
    often AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, a FROM counted WHERE a >= 30),
    inside AS (
        SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, size), lambda m:
            list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase
        FROM often WHERE size > 2
    ), most AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL),
    kept AS (
        SELECT often.* FROM often LEFT JOIN most ON often.lang = most.lang AND often.phrase = most.phrase
        WHERE size > 1 AND NOT coalesce(100 * longer::HUGEINT >= 80 * a::HUGEINT, false)
    ), cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
    ), scored AS (
        SELECT cuts.lang, cuts.phrase, cuts.a, k, h.a AS l, t.a AS r, ((2000000::HUGEINT * cuts.a) // (h.a::HUGEINT + t.a))::BIGINT AS score
        FROM cuts JOIN often h ON h.lang = cuts.lang AND h.phrase = head JOIN often t ON t.lang = cuts.lang AND t.phrase = tail
    ), lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
        FROM lowest WHERE nth = 1
    )
    SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sums ON sums.lang = ranked.lang WHERE rank <= 2000
    """
)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return collocations.collocations(table(spark, folder, "documents"))
