from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import empty, make, odd, with_clashes, words  # noqa: F401

from barsmith.llm import exact_dedup, quotient


def counter_of(data: bytes, bits: int):
    found, counts = quotient.unpack(data, bits)
    assert (np.diff(found) > 0).all()
    return Counter(dict(zip(found.tolist(), counts.tolist())))


@pytest.mark.parametrize("bits", [1, 3, 8, 17, 42, 60])
def test_filters_are_lossless(bits):
    rng = random.Random(bits)
    values = [rng.randrange(1 << bits) for _ in range(700)] + [5 % (1 << bits)] * 300
    parts = [values[:10], values[10:11], [], values[11:500], values[500:]]
    filters = [quotient.pack(*quotient.counted(np.array(p, np.int64)), bits) for p in parts]
    for f, p in zip(filters, parts):
        assert counter_of(f, bits) == Counter(p)
    whole = quotient.merge(filters, bits)
    assert counter_of(whole, bits) == Counter(values)
    assert whole == quotient.pack(*quotient.counted(np.array(values, np.int64)), bits)  # as if built at once
    assert counter_of(quotient.merge([], bits), bits) == Counter()


def test_filter_is_smaller_than_its_fingerprints():
    values = np.random.default_rng(2).integers(0, 1 << 52, 100_000)
    assert len(quotient.pack(*quotient.counted(values), 52)) < 6 * len(values)


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        known = [x for x in groups[t or ""] if x is not None]
        out.append((i, max(known, default=None), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def check(df, rows):
    got = df.collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == brute(rows)
    kept = [r for r in got if r["kept"]]
    assert Counter(r["text_sha256"] for r in kept) == Counter({h for *_, h in brute(rows)})  # one each
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


@pytest.mark.parametrize("bits", [2, 9, 60])  # few bits: unequal texts share fingerprints
def test_groups_equal_brute_force(spark, bits):
    rng = random.Random(bits)
    pool = [words(rng.randrange(1, 60), k) for k in range(120)] + ["", " ", "x", "X", "x "]
    rows = [(i, rng.choice(pool)) for i in range(500)] + [(3, "x"), (3, "x"), (None, "x"), (None, "only null"), (None, "only null"), (9, None)]
    rng.shuffle(rows)
    check(exact_dedup.grouped(make(spark, rows).repartition(6), bits=bits), rows)


def test_filters_cut_and_handed_on(spark, monkeypatch):
    rows = [(i, f"t{i % 90}") for i in range(400)]
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 20)
    monkeypatch.setattr(exact_dedup, "FILTER_SLOTS", 30)
    monkeypatch.setattr(exact_dedup, "MAP_WORDS", 1)  # a crowded bit map: more rows are verified, same result
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(exact_dedup.grouped(make(spark, rows)), rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows_and_clashing_names(spark, odd):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(exact_dedup.grouped(odd), rows)
    check(exact_dedup.grouped(with_clashes(odd).selectExpr("*", "'a' AS fingerprint", "'b' AS digest", "'c' AS `row`", "'d' AS `group_size`")), rows)


def test_hot_group_is_broadcast(spark):
    rows = [(i, "hot text" if i % 2 else f"t{i // 4}") for i in range(3000)]
    check(exact_dedup.grouped(make(spark, rows).repartition(8)), rows)


def test_keep_last_passes_all_columns(spark, odd):  # noqa: F811
    docs = with_clashes(odd).selectExpr("*", "'c' AS `row`", "'d' AS `a.b`")
    kept = exact_dedup.keep_last(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len({r["text"] or "" for r in odd.collect()})
    assert sorted((r["text"] or "") for r in got) == sorted({r["text"] or "" for r in odd.collect()})


def test_empty_table(spark, empty):  # noqa: F811
    assert exact_dedup.grouped(empty).count() == 0 and exact_dedup.keep_last(empty).count() == 0
