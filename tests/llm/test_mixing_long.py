"""Targets are met beside documents far longer than a block."""

from __future__ import annotations

import pytest

from barsmith.llm import mixing
from barsmith.llm.common import written

from llm_helpers import make, words


@pytest.mark.parametrize("seed", range(2))
def test_one_very_long_document_per_source(spark, seed):
    docs = make(spark, [(1000 * k + i, words(8000 if i == 0 else 20 + (i * 7) % 40, 100 * seed + i), "en", s) for k, s in enumerate("abc") for i in range(400)])
    got = mixing.draw(written(mixing.sized(docs), "sized"), block_words=500, shard_words=5000, seed=mixing.SEED + seed).toPandas()
    got["taken"] = got["size"] * got.shards.map(len)
    for _, g in got.groupby("source"):
        assert g.shards.map(len).max() <= 3
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 30


def test_only_long_documents(spark):
    docs = make(spark, [(100 * k + i, words(1000 + 37 * i, i), "en", s) for k, s in enumerate("ab") for i in range(30)])
    got = mixing.draw(written(mixing.sized(docs), "sized"), block_words=500, shard_words=5000).toPandas()
    got["taken"] = got["size"] * got.shards.map(len)
    for _, g in got.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1000
