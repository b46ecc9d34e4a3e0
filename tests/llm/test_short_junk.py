"""Texts between the base rule's length and 100 words."""

from __future__ import annotations

import random

from barsmith.llm import quality

from llm_helpers import make


def test_junk_of_50_to_99_words_goes_and_clean_text_stays(spark):
    rng = random.Random(7)
    common = "the of and to in that was for on with as his they at be this from have or by one had not but what all were when we there".split()
    clean = lambda n: " ".join(rng.choice(common) if rng.random() < 0.7 else f"word{rng.choice('abcdefgh')}{rng.choice('klmnop')}x" for _ in range(n))
    junk = lambda n: " ".join(f"buy{rng.choice('abcdefgh')}{rng.choice('klmnop')}{rng.choice('rstuv')}now" for _ in range(n))
    short = [clean(n) for n in range(50, 100, 5)]
    docs = make(spark, list(enumerate([clean(200) for _ in range(60)] + short + [junk(n) for n in range(50, 100, 5)])))
    rows = {r.doc_id: r.v for r in docs.select("doc_id", quality.verdict(docs).alias("v")).collect()}
    assert all(rows[i].kept for i in range(60 + len(short)))
    for i in range(60 + len(short), len(rows)):
        v = rows[i]
        assert not v.base_failed and not v.kept and v.word_distance > quality.WORD_LIMIT and (v.char_distance or 0) <= quality.CHAR_LIMIT
