"""The quality classifier against plain arithmetic, one number at a time."""

import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from partflow.llm import quality

BITS = 18
WRAP = (1 << 64) - 1


def plain_features(text):
    """Value of each feature by its place."""
    words = re.findall(r"\w+|[^\w\s]+", text.lower())

    def number(word):
        b = word.encode()
        return zlib.crc32(b) << 32 | zlib.crc32(b, 0x9E3779B9)

    numbers = [number("\x00again") if i and words[i] == words[i - 1] else number(w) for i, w in enumerate(words)]
    singles = [h * 0xA0761D6478BD642F & WRAP for h in numbers]
    pairs = [(a * 0x9E3779B97F4A7C15 + b) * 0xD6E8FEB86659FD93 & WRAP for a, b in zip(numbers, numbers[1:])]
    found = Counter(h >> 64 - BITS for h in singles + pairs)
    return {at: math.sqrt(n / (len(singles) + len(pairs))) for at, n in found.items()}


def plain_fit(rows):
    """Follow the regularised leader over the rows, each feature with its own step size."""
    z, n = Counter(), Counter()

    def weight(at):
        if abs(z[at]) <= quality.L1:
            return 0.0
        return -(z[at] - math.copysign(quality.L1, z[at])) / ((quality.BETA + math.sqrt(n[at])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for text, label in rows:
            values = plain_features(text) | {"bias": 1.0}
            weights = {at: weight(at) for at in values}
            p = 1 / (1 + math.exp(-sum(weights[at] * x for at, x in values.items())))
            for at, x in values.items():
                g = (p - label) * x
                z[at] += g - (math.sqrt(n[at] + g * g) - math.sqrt(n[at])) / quality.ALPHA * weights[at]
                n[at] += g * g
    return {at: weight(at) for at in z}


def test_scores_are_those_of_plain_arithmetic(spark):
    texts = {i: " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(3 + i % 9)) + ("." if i % 3 else " !! !!") for i in range(90)}
    texts |= {200: None, 201: "", 202: "the the the  cat", 203: "Äpfel, äpfel; 中文 中文"}
    labels = [(i, int(i % 3 > 0)) for i in texts] + [(5, 0), (None, 1), (999, 1)]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, labelled)).collect()}

    known = {}
    for key, label in labels:
        if key in texts and zlib.crc32(str(key).encode()) % 4 != 2:
            known[key] = min(label, known.get(key, 1))
    parts = {r.doc_id: r.part for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(quality.SHARDS)).alias("part")).collect()}
    models = []
    for part in sorted({parts[key] for key in known}):
        mine = sorted((key for key in known if parts[key] == part), key=lambda key: (zlib.crc32(str(key).encode(), 1), key))
        models.append(plain_fit([(texts[key] or "", known[key]) for key in mine]))
    mean = Counter()
    for model in models:
        for at, w in model.items():
            mean[at] += w / len(models)
    for key, text in texts.items():
        total = mean["bias"] + sum(mean[at] * x for at, x in plain_features(text or "").items())
        assert abs(got[key] - 1 / (1 + math.exp(-total))) < 1e-9, key
    assert got[200] == got[201] and len({round(s, 6) for s in got.values()}) > 50
