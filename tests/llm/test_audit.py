from __future__ import annotations

import random
from itertools import permutations

import pytest
from llm_helpers import empty, make, odd, with_clashes, words  # noqa: F401

from barsmith.llm import audit, transducer


def counts_of(text: bytes):
    w = text.split()
    return [len(w), len(set(w)), sum(65 <= b <= 90 for b in text), len(text.decode()), sum(b in b"#$%&*|" for b in text)]


@pytest.fixture
def texts():
    rng = random.Random(4)
    signs = ["a", "b", "é", "日", "😀", " ", "\n", "\x1c", "\x85", " ", "A", "#", "|", "0123456789" * 7]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(600))).encode() for _ in range(300)] + [b"", b" ", b"x"]


def test_one_pass_counts(texts):
    assert transducer.text_counts(texts).tolist() == [counts_of(t) for t in texts]


def test_cut_texts_count_the_same(texts, monkeypatch):
    monkeypatch.setattr(transducer, "SEGMENT_BYTES", 90)
    monkeypatch.setattr(transducer, "GROUP_BYTES", 250)
    assert transducer.text_counts(texts).tolist() == [counts_of(t) for t in texts]


def test_long_text_in_segments(monkeypatch):
    text = words(400_000, 3, 50_000).encode() + b" " + b"z" * 300_000
    monkeypatch.setattr(transducer, "SEGMENT_BYTES", 1 << 18)
    assert transducer.text_counts([b"a", text, b"a a"]).tolist() == [counts_of(b"a"), counts_of(text), counts_of(b"a a")]


def test_equal_hashes_are_told_apart(texts, monkeypatch):
    import numpy as np

    monkeypatch.setattr(transducer.Spans, "hashes", lambda self: np.zeros(len(self), "<u8"))
    some = [t for t in texts if len(t) < 200]
    assert transducer.text_counts(some).tolist() == [counts_of(t) for t in some]


def brute(rows, labels):
    """rows (doc_id, text, source), labels (doc_id, quality, toxic)."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for i, text, _ in rows:
        n, distinct, caps, points, symbols = counts_of((text or "").encode())
        again = i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in rows)
        fails.append("".join(x for x, f in zip("ABCDE", (n < 50, 100 * distinct < 65 * n, 100 * caps > 5 * points, symbols > 0, again)) if f))
    out = []
    for part in {s or "" for *_, s in rows}:
        mine = [(f, i) for f, (i, _, s) in zip(fails, rows) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        some = []
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [m for m in left if x in m[0]]
                left = [m for m in left if x not in m[0]]
                shapley[x] += len(gone)
                some.append((part, "".join(order), step, len(left), len(gone), sum(x in f for f, _ in mine) - len(gone), sum(f == x for f, _ in mine),
                             sum(i in good for _, i in gone), sum(i in toxic for _, i in gone), x))
        out += [(*r[:-1], shapley[r[-1]]) for r in some]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_audit_equals_brute_force(spark):
    rng = random.Random(8)
    pool = [words(60, k, 40 if k % 2 else 4000) + (" # " if k % 3 == 0 else "") + (" ABCDEFGHIJ" * 5 if k % 5 == 0 else "") for k in range(25)]
    pool += [words(20, 77), "", "A"]
    rows = [(i, rng.choice(pool), "en", rng.choice(["s", "t", None, ""])) for i in range(260)]
    rows += [(None, pool[0], None, "s"), (3, rows[3][1], "en", "s"), (500, None, "en", "u")]
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 200, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None)]
    want = brute([(i, t, s) for i, t, _, s in rows], labels)
    assert found(audit.audit(make(spark, rows), labelled(spark, labels))) == want
    assert found(audit.audit(with_clashes(make(spark, rows)).repartition(9), with_clashes(labelled(spark, labels)))) == want


def test_odd_rows(spark, odd):  # noqa: F811
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    labels = [(1, 1, 0), (5, 0, 1), (10, None, None)]
    assert found(audit.audit(odd, labelled(spark, labels))) == brute(rows, labels)


def test_empty_tables(spark, empty, odd):  # noqa: F811
    assert audit.audit(empty, labelled(spark, [(1, 1, 1)])).count() == 0
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    assert found(audit.audit(odd, labelled(spark, []))) == brute(rows, [])


def test_hot_text_and_hot_null_id(spark):
    rows = [(i, "same words " * 30 if i % 2 else f"text {i}", "en", "s") for i in range(400)] + [(None, f"n {i % 5}", "en", "s") for i in range(300)]
    labels = [(i, 1, i % 2) for i in range(400)]
    assert found(audit.audit(make(spark, rows).repartition(5), labelled(spark, labels))) == brute([(i, t, s) for i, t, _, s in rows], labels)
