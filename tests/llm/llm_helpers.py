"""Rows and checks shared by the tests of the training-data operators."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def make(spark, rows):
    """documents of (doc_id, text[, lang[, source]]) rows."""
    full = [(i, t, *(list(r) + ["en", "s"][len(r):])) for i, t, *r in rows]
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in full], DOCS)


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows."""
    long_text = words(30_000, 5)
    return make(spark, [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, words(80, 1)), (5, words(80, 1)), (None, words(80, 1), None, None),
        (7, long_text, "en", "s"), (8, words(80, 1), None, "s"), (9, "..!! 12 &&", "de", None), (10, "été à Noël " * 20, "fr", "t"),
        (4, "word"), (11, "日本語 の 文", "ja", "t"),
    ])


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


CLASH = ("key", "size", "shard", "block", "token", "node", "verdict", "v", "_mix_key", "_text_hash", "score", "copies")


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(c).alias(c) for c in CLASH])


def brute_components(rows):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        r = find(a)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, len(s), least.get(find(a))) for a, ((i, _), s) in enumerate(zip(rows, sets))), key=str)
