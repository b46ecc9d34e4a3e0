from __future__ import annotations

import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.llm import jaccard, lattice, licenses, mixing, sharding, topk
from barsmith.llm.common import written

from llm_helpers import SMALL, brute_components, empty, make, odd, with_clashes, words  # noqa: F401


# ------------------------------------------------------------------- op10


def test_top_k_equals_sql(spark):
    con = duckdb.connect()
    for name in ("embeddings", "documents"):
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    got = sorted(map(tuple, topk.query(spark, SMALL).collect()))
    assert got == sorted(con.sql(topk.SQL).fetchall())
    from barsmith.llm.queries import spark_queries

    scan = spark_queries()["op8_license_scan"](spark, SMALL)
    assert sorted(map(tuple, scan.collect())) == sorted(con.sql(licenses.oracle()).select(*scan.columns).fetchall())


def test_top_k_edge_cases_and_ties(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(120)]
    rows += [(200, None), (250, []), (300, [1.0, None]), (350, [float("nan")] * 6), (400, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(500, [1.0, 2.0]), (501, rows[7][1]), (502, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("values", F.lit(1))
    vectors = written(topk.integer_vectors(df), "vectors")
    got = sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 50 == 0, shard_rows=16, query_rows=2).collect()))
    valid = {i: np.array([math.floor(256 * x) for x in v] + [0] * (6 - len(v))) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in valid:
        if q % 50 == 0:
            best = sorted(((-int(valid[q] @ v), i) for i, v in valid.items() if i != q))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    few = written(topk.integer_vectors(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")), "few")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    none = written(topk.integer_vectors(df.limit(0)), "none")
    assert topk.top_k(none, F.col("vec_id") % 50 == 0).count() == 0


# -------------------------------------------------------------------- op3


def brute_key(rows):
    return sorted(rows, key=lambda r: (r["key"], r["doc_id"] is not None, r["doc_id"], r["text_crc32"]))


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_are_sorted_gapless_and_balanced(spark, shards):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = sharding.shard(written(sharding.keyed(docs), "keyed"), shards).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    order = brute_key([r.asDict() for r in got])
    assert [r["shard"] for r in order] == sorted(r["shard"] for r in order)
    slots: dict[int, int] = {}
    for r in order:
        assert r["slot"] == slots.get(r["shard"], 0)
        slots[r["shard"]] = r["slot"] + 1
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    sizes = np.bincount([r.shard for r in got], [r.size for r in got], shards)
    assert np.abs(np.cumsum(sizes) - sizes.sum() * np.arange(1, shards + 1) / shards).max() <= max(r.size for r in got)


def test_hot_text_is_split_only_where_needed(spark):
    rows = [(i, "copy " * 40) for i in range(400)] + [(1000 + i, words(30, i)) for i in range(400)]
    got = sharding.shard(written(sharding.keyed(make(spark, rows)), "keyed"), 10)
    sizes = [r.n for r in got.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) / min(sizes) < 1.1
    small = [(i, words(30, i // 2)) for i in range(2000)]  # pairs of copies fit the tolerance
    got = sharding.shard(written(sharding.keyed(make(spark, small)), "keyed"), 5, tolerance=0.02)
    assert got.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


def test_sharding_edge_cases(spark, odd, empty):
    got = sharding.shard(written(sharding.keyed(with_clashes(odd)), "keyed")).collect()
    assert len(got) == odd.count() and min(r.size for r in got) == 16
    assert sharding.shard(written(sharding.keyed(empty), "keyed")).count() == 0


# -------------------------------------------------------------------- op5


def near_copies(seed, groups=12):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(groups):
        base = words(rng.choice([3, 5, 7, 20, 60, 300]), seed * 100 + g, 5000).split()
        if rng.random() < 0.4:
            base = base + passage[: rng.randrange(60)]
        for _ in range(rng.choice([1, 2, 8, 30])):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 20)):
                t[rng.randrange(len(t))] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(t).title() if rng.random() < 0.3 else " ".join(t)))
    return rows


@pytest.mark.parametrize(("seed", "frequent"), [(1, 0), (2, 2), (3, 32), (4, 1)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = near_copies(seed)
    got = jaccard.near_duplicates(make(spark, rows)).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_signatures_survive_every_loss():
    """Any two similar sets share a signature, whichever tokens are frequent."""
    rng = np.random.default_rng(5)
    for _ in range(600):
        n = int(rng.integers(1, 220))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = rng.random(len(x)) > rng.random() * 0.25
        y = np.unique(np.append(x[keep], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 6))).astype(np.uint64)))
        both = len(np.intersect1d(x, y))
        frequent = np.sort(x[rng.random(len(x)) < rng.random()])
        if 100 * both >= 75 * (len(x) + len(y) - both):
            small, large = sorted((x, y), key=len)
            sigs, smaller, _ = jaccard.signatures(small, frequent)
            assert np.intersect1d(sigs[smaller], jaccard.signatures(large, frequent)[0]).size
            a, b = jaccard._parity(x), jaccard._parity(y)
            import pyarrow as pa

            assert jaccard._may_be_similar.func(pa.array([a]), pa.array([b]), pa.array([len(x)]), pa.array([len(y)]))[0].as_py()


def test_near_duplicate_edge_cases(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = jaccard.near_duplicates(with_clashes(odd)).drop("text_hash").collect()
    want = brute_components(rows)
    # without words: linked with nothing, its own name
    want = sorted(((i, n, c if n else i) for i, n, c in want), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert jaccard.near_duplicates(empty).count() == 0
    wide = with_clashes(odd)
    kept = jaccard.keep_one(wide)
    assert kept.columns == wide.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 7, 9, 10, 11, None], key=str)


# -------------------------------------------------------------------- op1


def test_targets_share_out_the_excess():
    rng = random.Random(6)
    for _ in range(200):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 50_000]) for i in range(rng.randrange(1, 9))}
        if rng.random() < 0.5:
            sizes[None] = rng.randrange(100)
        goal = mixing.targets(sizes)
        assert sum(goal.values()) == pytest.approx(sum(sizes.values()))
        assert all(goal[s] <= 3 * sizes[s] + 1e-6 for s in sizes)
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        level = {s: goal[s] / (1 + i % 3) for i, s in enumerate(names)}
        free = [level[s] for s in names if goal[s] < 3 * sizes[s] - 1e-6]
        assert not free or max(free) - min(free) < 1e-6 * max(1, max(free))
        assert all(level[s] <= max(free, default=math.inf) + 1e-6 for s in names)


def test_quotas_are_exact_and_disjoint():
    copies, shards = [700, 0, 33, 1, 260], 13
    leaves = [mixing.shard_quotas(copies, shards, j) for j in range(shards)]
    for s, n in enumerate(copies):
        at = 0
        for first, number in leaves:
            assert first[s] == at
            at += number[s]
        assert at == n
    totals = [int(n.sum()) for _, n in leaves]
    assert max(totals) - min(totals) <= 1


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = written(mixing.sized(docs), "sized")
    got = mixing.draw(rows, block_words=500, shard_words=2000).toPandas()
    again = mixing.draw(rows, block_words=500, shard_words=2000).toPandas()
    shards = lambda f: {i: list(s) for i, s in zip(f.doc_id, f.shards)}
    assert shards(got) == shards(again)
    got["taken"] = got["size"] * got.shards.map(len)
    for _, g in got.groupby("source"):
        assert g.shards.map(len).max() <= 3
        assert abs(g.taken.sum() - g.target.iloc[0]) <= max(0.03 * g.target.iloc[0], g["size"].max() / 2)
    counts = np.bincount([s for x in got.shards for s in x])
    assert len(counts) > 5 and counts.min() > 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(n == len(texts[i].encode().split()) for i, n in zip(got.doc_id, got["size"]))


def test_mix_rows_keeps_columns_and_takes_copies(spark, odd, empty):
    wide = with_clashes(odd)
    mixed = mixing.mix_rows(wide)
    assert mixed.columns == wide.columns
    drawn = mixing.draw(written(mixing.sized(odd), "sized"))
    assert mixed.count() == sum(len(r.shards) for r in drawn.collect())
    assert drawn.filter("size = 0 and size(shards) > 0").count() == 0
    assert drawn.count() == odd.count()
    assert mixing.mix_rows(empty).count() == 0


# -------------------------------------------------------------------- op2


def test_forward_recursion_sums_all_segmentations():
    rng = random.Random(7)
    inner = {bytes([c]): math.log(0.05) for c in b"abc"} | {b"ab": math.log(0.02), b"bca": math.log(0.01)}
    ending = {bytes([c]): math.log(0.04) for c in b"abc"} | {b"ca": math.log(0.03), b"abca": math.log(0.02)}

    def total(word):
        out = math.exp(ending[word]) if word in ending else 0.0
        return out + sum(math.exp(inner[word[:k]]) * total(word[k:]) for k in range(1, len(word)) if word[:k] in inner)

    for _ in range(50):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 9)))
        assert lattice.log_probability(word, None, inner, ending, 4) == pytest.approx(math.log(total(word)))
        assert lattice.log_probability(word, math.log(0.1), inner, ending, 4) == pytest.approx(math.log(total(word) + 0.1))


@pytest.mark.parametrize("head", [10**6, 50])
def test_base_score_and_counts_match_brute_force(spark, monkeypatch, head):
    from collections import Counter

    monkeypatch.setattr(lattice, "HEAD_WORDS", head)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text.encode().lower().split() for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    c, ends = Counter(), 0
    for i, w in texts.items():
        if not held[i]:
            c.update(w)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    p = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    for r in lattice.query(spark, SMALL).collect():
        w = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(w) + 1, n)
        assert r.n_known == 1 + sum(c[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(p(c[x]) for x in w) + p(ends))
        assert -40 * len(b" ".join(w)) - 40 < r.score < 0


def test_unit_scores_are_a_distribution(spark):
    from barsmith.llm import tokens

    docs = make(spark, [(i, words(50, i)) for i in range(20)]).withColumn("held_out", F.lit(False))
    table = written(lattice.word_counts(docs), "words")
    model = lattice.train(table, 20, tokens.tokenizer_path())
    whole = sum(r.c - lattice.DISCOUNT for r in table.collect()) / model["total"]
    assert whole + np.exp(model["piece"]).sum() + math.exp(model["end"]) == pytest.approx(1)
    inner, ending = lattice.load_pieces(tokens.tokenizer_path())
    assert all(bytes([b]) in inner and bytes([b]) in ending for b in range(256))


def test_score_edge_cases(spark, odd, empty):
    got = lattice.score_documents(with_clashes(odd)).collect()
    assert len(got) == odd.count()
    bare = [r for r in got if r.doc_id in (1, 2, 3)]
    assert all(r.n_tokens == 1 and math.isfinite(r.score) for r in bare) and len({r.score for r in bare}) == 1
    same = {r.score for r in got if r.doc_id == 5}
    assert len(same) == 1
    assert lattice.score_documents(empty).count() == 0
