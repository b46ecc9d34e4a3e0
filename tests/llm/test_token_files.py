from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barsmith.llm import idcoder, packing, tokenfile, tokens
from barsmith.llm.common import scratch

from llm_helpers import SMALL, empty, make, odd, with_clashes, words  # noqa: F401

HARD = "Don't <|ENDOFTEXT|> a<|endoftext|>. x İstanbul... é!! ≮ é 3.5, (x) ??!\x1c\x85 naïve,  nbsp 日本。a.b c,d…e…,"


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_the_whole_text(spark, whole):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + [HARD, "", "  ", HARD.upper(), words(500, 1)]
    enc = tokens.WordEncoder(tokens.tokenizer_path())
    for t, ids in zip(texts, enc.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u2").tolist() == whole(t)


def test_word_memory_is_bounded(monkeypatch, whole):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    enc = tokens.WordEncoder(tokens.tokenizer_path())
    for i in range(20):
        t = words(30, i)
        assert np.frombuffer(enc.encode([t.encode()])[0], "<u2").tolist() == whole(t)
    assert len(enc._ids) < 100


def test_coder_round_trip():
    rng = np.random.default_rng(2)
    blocks = [
        (rng.zipf(1.3, 3000) % 49_000).astype(np.uint16), np.zeros(2000, np.uint16), np.full(777, 65_535, np.uint16), np.zeros(0, np.uint16),
        rng.integers(0, 65_536, 2500).astype(np.uint16), np.tile(np.arange(50, dtype=np.uint16), 40), np.array([7], np.uint16),
    ]
    coded = idcoder.encode_blocks(blocks)
    for a, b in zip(blocks, idcoder.decode_blocks(coded)):
        assert a.tolist() == b.tolist()
    # every block stands alone, and codes alike whatever lies beside it
    for k, c in enumerate(coded):
        assert idcoder.decode_blocks([c])[0].tolist() == blocks[k].tolist()
        assert idcoder.encode_blocks([blocks[k]])[0] == c
    assert len(coded[5]) < 2 * len(blocks[5]) / 8  # repeats are predicted
    assert len(coded[0]) < 2 * len(blocks[0]) * 0.8


def test_damage_is_found():
    coded = idcoder.encode_blocks([np.arange(500, dtype=np.uint16)])[0]
    for at in (0, 5, 9, 13, 20, len(coded) - 1):
        bad = bytearray(coded)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            idcoder.decode_blocks([bytes(bad)])


def test_checksums_of_concatenations():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.bytes(int(rng.integers(0, 300))), rng.bytes(int(rng.integers(0, 300)))
        assert tokenfile.crc32_concat(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def read_back(spark, docs, **kw):
    path = scratch(spark, "ids")
    tokenfile.write_ids(docs, path, **kw)
    sizes = {k: v for k, v in kw.items() if k in ("block_ids", "lanes")}
    return tokenfile.read_ids(spark, path, **sizes).collect()


@pytest.mark.parametrize(("block_ids", "lanes"), [(4096, 512), (16, 8)])
def test_token_file_round_trip(spark, odd, whole, block_ids, lanes):
    docs = with_clashes(odd.filter("doc_id is null or doc_id <> 7")).drop("key")
    got = read_back(spark, docs, block_ids=block_ids, lanes=lanes)
    rows = sorted(((r.doc_id, r.text) for r in odd.collect() if r.doc_id != 7), key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    want, at = [], 0
    for i, t in rows:
        ids = [*whole(t), 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_file_of_nothing(spark, empty):
    assert read_back(spark, empty) == []


def test_query_reads_every_document(spark, whole):
    got = sorted(tokenfile.query(spark, SMALL).collect(), key=lambda r: r.start)
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    at = 0
    for r, d in zip(got, docs, strict=True):
        ids = [*whole(d.text), 2]
        assert tuple(r) == (d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# -------------------------------------------------------------------- packing


def fewest(lengths, capacity):
    """Fewest sequences by trying all partitions."""
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                put(i + 1, [r - lengths[i] * (j == k) for j, r in enumerate(rooms)])
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


def test_bound_and_best_fit_frame_the_optimum():
    rng = np.random.default_rng(4)
    for _ in range(150):
        lengths = rng.integers(1, 21, int(rng.integers(1, 8)))
        _, _, room = packing.best_fit_decreasing(lengths, 20)
        best = fewest(sorted(lengths.tolist(), reverse=True), 20)
        assert packing.lower_bound(lengths, 20) <= best <= len(room)
    assert packing.lower_bound(np.array([], int), 20) == 0
    assert packing.lower_bound(np.array([11] * 9), 20) == 9  # no two fit


def check_packed(rows, capacity):
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        ends = [0, *itertools.accumulate(n for _, n in parts)]
        assert [o for o, _ in parts] == ends[:-1] and ends[-1] <= capacity
    return len(by_sequence)


def test_packing_covers_every_id(spark, odd, whole):
    got = packing.pack_documents(with_clashes(odd), capacity=64).collect()
    check_packed(got, 64)
    pieces = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str)
    want = []
    for r in odd.collect():
        ids = [*whole(r.text), 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want.append((r.doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert pieces == sorted(want, key=str)


def test_groups_exchange_until_the_bound_is_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from barsmith.llm.common import written

    pieces = written(packing.cut(docs, tokens.tokenizer_path()), "pieces")
    got = packing.pack(pieces, group_pieces=100).collect()
    n = check_packed(got, packing.CAPACITY)
    assert len(got) == pieces.count()
    bound = packing.lower_bound(np.array([r.length for r in got]), packing.CAPACITY)
    assert n <= bound + max(1, bound // 200)


def test_packing_of_nothing(spark, empty):
    assert packing.pack_documents(empty).count() == 0


def test_repeated_documents_are_packed_each(spark):
    docs = make(spark, [(1, "same text"), (1, "same text"), (2, None)])
    got = packing.pack_documents(docs)
    assert got.count() == 3 and got.select(F.sum("length")).first()[0] == sum(r.length for r in got.collect())
