"""Predictions that don't depend on neighbours or pieces; shards that keep groups of copies."""

from __future__ import annotations

import random
import resource

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barsmith.llm import language, quality, sharding
from barsmith.llm.common import text_bytes, written
from llm_helpers import make, words

EN = ["the", "and", "with", "thing", "white", "house", "which"]
RU = ["это", "было", "слово", "только", "дом"]


def _model(langs=5, seed=3):
    rng = np.random.default_rng(seed)
    uses = np.zeros((langs, language.N_SCRIPTS), bool)
    uses[:, 0] = True
    uses[0, 2] = True
    return {"langs": [f"l{i}" for i in range(langs)], "score": rng.normal(size=(1 << language.SLOT_BITS, langs)).astype(np.float32) * 3, "uses": uses}


def _rows(texts, model):
    return language.label_batch(pa.array(texts, pa.binary()), model).to_pylist()


def test_label_does_not_depend_on_neighbours():
    rng, model = random.Random(1), _model()
    texts = ["".join(rng.choice("abcd éж  \n") for _ in range(rng.randrange(1, 30))).encode() for _ in range(60)] + [b"", b"abcd", b"abcd"]
    alone = [_rows([t], model)[0] for t in texts]
    assert _rows(texts, model) == alone
    for other in texts:
        assert _rows([other, b"abcd"], model)[1] == alone[-1]


@pytest.mark.parametrize("piece", [16, 100, 1000])
def test_long_texts_in_pieces_equal_one_pass(monkeypatch, piece):
    rng, model = random.Random(piece), _model()
    texts = [" ".join("".join(rng.choice("abcé") for _ in range(rng.choice([1, 3, 8, 300]))) for _ in range(400)).encode(), b"  \n " * 500, b"x" * 5000,
             b" " * 300 + b"abc " * 600 + b"  ", "ж".encode() * 999]
    whole = _rows(texts, model)
    monkeypatch.setattr(language, "group_bytes", lambda model: piece)
    for got, want in zip(_rows(texts, model), whole):
        assert (got["lang_pred"], got["spans"]) == (want["lang_pred"], want["spans"])
        assert got["score"] == pytest.approx(want["score"])


def test_very_long_text_in_bounded_memory():
    model, text = _model(), b"some words of a long text " * 800_000  # 20 MB
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (row,) = _rows([text], model)
    assert sum(s["n_words"] for s in row["spans"]) == 4_800_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB


def test_rare_language_is_learned_and_sample_bounded(spark):
    rng = random.Random(5)
    text = lambda w: " ".join(rng.choice(w) for _ in range(20))
    rows = [(i if i % 3 else None, text(EN), "en") for i in range(3000)] + [(10_000 + i, text(RU), "ru") for i in range(3)]
    docs = make(spark, rows)
    drawn = {r["lang"]: r["count"] for r in language.sample(docs, 200).groupBy("lang").count().collect()}
    assert drawn["ru"] == 3 and 120 < drawn["en"] < 280
    same = make(spark, [(None, "the same text", "en")] * 4000)  # rows without an id are drawn one by one
    assert 120 < language.sample(same, 200).count() < 280
    model = language.fit(docs, 200)
    got = make(spark, [(1, text(RU)), (2, text(EN))]).select("doc_id", language.label_udf(model)(text_bytes())["lang_pred"].alias("l"))
    assert dict(map(tuple, got.collect())) == {1: "ru", 2: "en"}


def test_scripts_that_no_language_uses_are_not_kept(spark):
    docs = make(spark, [(i, "the white house and the thing " * 3, "en") for i in range(20)] + [(100, "தமிழ் மொழி " * 5, None), (101, "ไทย ภาษา " * 5, None), (102, "12 !!", None)])
    found = {r.doc_id: r.v for r in docs.select("doc_id", language.identify(docs).alias("v")).collect()}
    assert (found[100].lang_pred, found[100].score) == ("en", 0.0) and (found[101].lang_pred, found[101].score) == ("en", 0.0)
    assert found[102].lang_pred == "und"
    assert {r.doc_id for r in language.keep_identified(docs).collect()} == set(range(20))


def test_short_words_are_counted_in_characters():
    assert [quality.is_short(w.encode()) for w in ("abcdef", "abcdefg", "только", "толькоо", "हिन्दी", "日本語の文字", "日本語の文字列")] == [True, False, True, False, True, True, False]


def _split_groups(got):
    return got.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).filter("n > 1")


def test_small_groups_stay_whole_in_forty_shards(spark):
    rows, i = [], 0
    for g in range(404):
        for _ in range(2 + g % 2):
            rows.append((i, words(25, g)))
            i += 1
    got = sharding.shard(written(sharding.keyed(make(spark, rows)), "keyed"))
    assert _split_groups(got).count() == 0
    sizes = np.bincount(*[[r[c] for r in got.select("shard", "size").collect()] for c in ("shard", "size")], 40)
    largest = max(r["size"] for r in got.select("size").collect())
    assert np.abs(np.cumsum(sizes) - sizes.sum() * np.arange(1, 41) / 40).max() <= 1.5 * largest


def test_slices_hold_about_as_many_rows(spark):
    # a group of copies holds most rows: its keys are one sliver of the key space
    rows = written(sharding.keyed(make(spark, [(i, "copy " * 40) for i in range(3000)] + [(9000 + i, words(9, i)) for i in range(500)])), "keyed")
    cuts = sharding.boundaries(rows, 20, "rows", sharding.SLICE_MISS, False)
    _, below = sharding.histogram(rows, sorted(set(cuts)))
    assert max(np.diff([0, *below, 3500])) <= 1.6 * 3500 / 20
    got = sharding.shard(rows, 4, slice_rows=100).collect()
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
