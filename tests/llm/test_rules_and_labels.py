from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.llm import language, licenses, quality
from barsmith.llm.common import text_bytes

from llm_helpers import SMALL, empty, make, odd, with_clashes, words  # noqa: F401

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_features(text):
    text = text or ""
    w = SPACE.findall(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_features_match_brute_force(spark):
    got = quality.query(spark, SMALL)
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    for r in got.join(texts, "doc_id").collect():
        n, chars, symbols, dup, repeat = brute_features(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.base_failed and r.kept)


def test_quality_edge_cases(spark, odd, empty):
    rows = odd.select("doc_id", "text", quality.verdict(odd).alias("v")).collect()
    for r in rows:
        assert (r.v.n_words, r.v.word_chars, r.v.n_symbols, r.v.n_dup_lines, r.v.n_repeat_words) == brute_features(r.text)
    assert quality.keep_good(empty).count() == 0
    assert quality.keep_good(empty).columns == empty.columns
    wide = with_clashes(odd)
    kept = quality.keep_good(wide)
    assert kept.columns == wide.columns and kept.count() == sum(r.v.kept for r in rows)
    nameless = make(spark, [(1, words(80, 3), None, None)])
    assert quality.keep_good(nameless).count() == 1  # no reference, base rule only


def test_quality_rejects_divergent_text_and_keeps_clean(spark):
    rng = random.Random(4)
    common = ["the", "of", "and", "to", "in"]
    clean = [" ".join(rng.choice(common) if rng.random() < 0.4 else f"word{rng.randrange(500)}x" for _ in range(200)) + "." for _ in range(60)]
    junk = [" ".join(f"{rng.randrange(10**6)}###" for _ in range(200)) for _ in range(3)]
    shouting = [clean[0].upper().replace(" ", "!! ")]
    docs = make(spark, list(enumerate(clean + junk + shouting)))
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == set(range(60))


def test_js_distance_by_definition():
    rng = np.random.default_rng(0)
    for _ in range(20):
        p, q = rng.random(6), rng.random(6)
        p, q = p / p.sum(), q / q.sum()
        m = (p + q) / 2
        want = np.sqrt((np.sum(p * np.log2(p / m)) + np.sum(q * np.log2(q / m))) / 2)
        assert quality.js_distance(p, q) == pytest.approx(want)
        # bins without a count may be left out
        z = np.append(p[:4] / p[:4].sum(), [0, 0])
        assert quality.js_distance(z[:4], q[:4], q[4:].sum()) == pytest.approx(quality.js_distance(z, q))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(100):
        langs = int(rng.integers(1, 5))
        lengths = rng.integers(0, 3 * language.SEGMENT, rng.integers(1, 6))
        first = np.cumsum(lengths) - lengths
        scores = rng.normal(size=(lengths.sum(), langs)) * 3
        labels = language.viterbi(scores, first, 2.0)
        for a, n in zip(first, lengths):
            if n:
                best = scores[a].copy()
                for t in range(1, n):
                    best = np.maximum(best, best.max() - 2.0) + scores[a + t]
                got = labels[a : a + n]
                value = scores[np.arange(a, a + n), got].sum() - 2.0 * (got[1:] != got[:-1]).sum()
                assert value == pytest.approx(best.max())


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = language.query(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert len(got) > 100 and right / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(spark, odd, empty):
    rows = odd.select("doc_id", "text", language.identify(odd).alias("v")).collect()
    for r in rows:
        assert (r.v.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert sum(s.n_words for s in r.v.spans) == len(SPACE.findall(r.text or ""))
    assert empty.select(language.identify(empty).alias("v")).count() == 0
    unlabelled = make(spark, [(2, "some text", None)])
    assert unlabelled.select(language.identify(unlabelled)["lang_pred"].alias("l")).first().l == "und"
    wide = with_clashes(odd)
    kept = language.keep_identified(wide)
    assert kept.columns == wide.columns and kept.count() == sum(r.v.lang_pred != "und" for r in rows)


def test_language_spans_of_mixed_text(spark):
    rng = random.Random(2)
    en = lambda n: " ".join(rng.choice(["the", "and", "with", "thing", "white", "house", "which"]) for _ in range(n))
    ru = lambda n: " ".join(rng.choice(["это", "было", "слово", "только", "дом"]) for _ in range(n))
    de = lambda n: " ".join(rng.choice(["der", "und", "nicht", "schön", "straße", "zwischen"]) for _ in range(n))
    train = make(spark, [(i, f(60), x) for i, (f, x) in enumerate([(en, "en"), (ru, "ru"), (de, "de")] * 20)])
    model = language.fit(train)
    text = f"{en(30)} {ru(20)} {de(30)}"
    spans = make(spark, [(1, text)]).select(language.label_udf(model)(text_bytes()).alias("v")).first().v.spans
    assert [s.lang for s in spans] == ["en", "ru", "de"]
    assert [s.n_words for s in spans] == [30, 20, 30]


def test_license_scan_matches_brute_force(spark, odd, empty):
    mit, apache = licenses.KNOWN_TEXTS[0][1], licenses.KNOWN_TEXTS[4][1]
    ids, ordered = licenses.rules()
    wrapped = "\n".join(re.findall(r".{1,70}(?:\s|$)", mit.lower()))
    texts = ["plain words. Released under the MIT License.\nmore", f"Copyright (c) X\n{mit}\n\n{apache}", wrapped, "Released under the\nMIT License.",
             "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", "released UNDER the mit   license!", mit.split("\n")[1]]
    docs = make(spark, [(i, t) for i, t in enumerate(texts)]).unionByName(odd)
    for r in docs.select("text", licenses.scan(F.col("text")).alias("v")).collect():
        found = licenses.sentences(r.text or "")
        known = [ids[s] for s in found if s in ids]
        names, rest = [], known
        while rest:
            for rule, name in ordered:
                n = rule.count(" ")
                if " ".join(rest[:n]) + " " == rule:
                    names.append(name)
                    break
            else:
                n = 1
            rest = rest[n:]
        assert (r.v.n_sentences, r.v.n_known, r.v.sentence_ids, r.v.licenses, r.v.n_matches) == (len(found), len(known), " ".join(known), ";".join(names), len(names))
    got = [r.l for r in make(spark, [(i, t) for i, t in enumerate(texts)]).orderBy("doc_id").select(licenses.scan(F.col("text"))["licenses"].alias("l")).collect()]
    assert got[0] == "MIT" and got[1] == "MIT;Apache-2.0" and got[4] == "CC-BY-NC-4.0;CC-BY-NC-4.0" and got[6] == ""
    assert empty.select(licenses.scan(F.col("text"))).count() == 0
