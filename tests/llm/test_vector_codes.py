from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm import vector_codes as V

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
])


def brute(rows, entries=64, rounds=2):
    """Everything in Python integers, all distances."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // 16) * 16
    size = width // 16
    whole = [[math.floor(256 * x) if abs(x) < 2**52 else 256 * int(x) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    parts = [[v[p * size : (p + 1) * size] for p in range(16)] for v in whole]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[parts[i][p] for i in order] for p in range(16)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min((apart(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        found = [[near(p, v[p])[1] for p in range(16)] for v in parts]
        for p in range(16):
            for k in range(len(books[p])):
                mine = [v[p] for v, f in zip(parts, found) if f[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    out, labels = [], {}
    for r, v in zip(kept, parts):
        best = [near(p, v[p]) for p in range(16)]
        error = sum(b[0] for b in best)
        labels[r[2]] = labels.get(r[2], 0) + error
        out.append((r[0], "".join(f"{b[1]:02x}" for b in best), error, r[2]))
    fits = lambda x: x if x <= V.LONGEST else None
    sha = V.checksum(books)
    bad = {lab for *_, e, lab in out if fits(e) is None}
    return sorted([(i, code, fits(e), None if lab in bad else fits(labels[lab]), sha) for i, code, e, lab in out], key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("high,width", [(3, 4), (100, 4), (2**40, 4), (5, 0), (7, 1)])
def test_nearest_meets_every_distance(high, width):
    rng = np.random.default_rng(3)
    parts, entries = rng.integers(-high, high, (300, width)), rng.integers(-high, high, (64, width)).astype(object)
    entries[10] = entries[3]
    index, best = V.nearest(parts, entries)
    for part, i, d in zip(parts.tolist(), index, best):
        assert min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(entries.tolist())) == (d, i)


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 32)], int(i % 3)) for i in rng.permutation(150)]
    rows += [(7, rows[0][1], None), (None, rows[1][1], None), (7, rows[0][1], 1)]  # repeated ids, null id and label
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 32, 2), (503, [float("inf")] * 32, 2)]
    assert found(V.vector_codes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_ragged_empty_and_large_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 1, n)], 1) for i, n in enumerate([0, 3, 20, 33, 33, 33])]
    rows += [(90, [1e10] * 33, 2), (91, [-1e300] * 5, 3), (92, [0.5] * 33, 3), (93, [float(2**53 + 2)] * 33, 4)]
    assert found(V.vector_codes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    got = V.vector_codes(spark.createDataFrame(rows, SCHEMA), entries=1)
    assert found(got) == brute(rows, 1) and {r["error"] for r in got.collect() if r["vec_id"] == 91} == {None}


def test_empty_tables_and_clashing_names(spark):
    assert V.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert V.vector_codes(only).count() == 0
    rows = [(i, [i / 7.0] * 16, i % 2) for i in range(80)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(c).alias(c) for c in ("code", "error", "members", "_found", "vector", "part")])
    assert found(V.vector_codes(docs)) == brute(rows)


def test_hot_label_and_repeated_rows(spark):
    rows = [(i % 50, [(i % 50) / 3.0] * 16, None if i % 3 else 1) for i in range(3000)]
    assert found(V.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(7))) == brute(rows)
