"""Language-model scores by subword lattice likelihood.

A text is its words and an end. The units a word can be made of are the word itself,
if the training documents have it, and the pieces of an existing public subword
vocabulary (byte level, so every word has a segmentation): inner pieces, then one that
ends a word. One unigram distribution covers all units; a word's probability is the
sum over all its segmentations, by a forward recursion in log space.

Scores of the units come from the training documents: a word counted c times keeps
c - ``DISCOUNT``; the discount goes to the pieces that spell it (longest match), every
piece gets ``FLOOR`` besides, the end one count per document.

Each distinct word goes through its lattice once. Documents look up the frequent words
(at most ``HEAD_WORDS``, a bounded broadcast); all other words are joined, so the
vocabulary may grow with the corpus without bound.

Edge cases: a null or empty text is the end alone. A null ``doc_id`` counts as training.
Repeated rows are scored (and learned from) one by one. Without training documents
only the pieces' floor is left. Words of any length are scored whole. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import tokens
from barsmith.llm.common import documents, in_fold, small_batches, text_bytes, written

FOLDS, HELD_OUT = 5, 1
DISCOUNT = 0.5
FLOOR = 0.01
END_FLOOR = 0.5
HEAD_WORDS = 300_000
FLUSH = 300_000  # distinct words held per task before they are handed on


# ---------------------------------------------------------------- vocabulary


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin-1 characters stand for themselves, all others follow from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_pieces(path: str) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """(inner pieces, word-ending pieces) of the vocabulary, with their ids."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    byte = _byte_of()
    inner, ending = {}, {}
    for piece, i in vocabulary.items():
        ends = piece.endswith("</w>")
        raw = bytes(byte[c] for c in (piece[:-4] if ends else piece))
        (ending if ends else inner)[raw] = i
    return inner, ending


def spell(word: bytes, inner: dict, ending: dict, longest: int) -> list[int]:
    """Ids of the pieces of ``word`` by longest match; the last one ends the word."""
    out, at, n = [], 0, len(word)
    while at < n:
        if n - at <= longest:
            i = ending.get(word[at:])
            if i is not None:
                out.append(i)
                break
        for size in range(min(longest, n - at - 1), 0, -1):
            i = inner.get(word[at : at + size])
            if i is not None:
                out.append(i)
                at += size
                break
    return out


def log_probability(word: bytes, whole: float | None, inner: dict, ending: dict, longest: int) -> float:
    """Natural log of the summed probability of all segmentations of ``word``.

    ``whole`` is the log score of the word as a unit. ``inner`` and ``ending`` map
    pieces to log scores.
    """
    n = len(word)
    forward = [0.0] * (n + 1)  # forward[i]: log sum over segmentations of word[:i] into inner pieces
    for end in range(1, n + 1):
        known = inner if end < n else ending
        terms = []
        for start in range(max(0, end - longest), end):
            score = known.get(word[start:end])
            if score is not None:
                terms.append(forward[start] + score)
        if end == n and whole is not None:
            terms.append(whole)
        top = max(terms)
        forward[end] = top if len(terms) == 1 else top + math.log(sum([math.exp(t - top) for t in terms]))
    return forward[n]


# -------------------------------------------------------------------- training


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, c): counts in training texts, 0 for words that only held-out texts have."""
    counts: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "c"])

    for batch in batches:
        for held_out, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = (text.as_py() or b"").lower().split()
            if held_out:
                for w in words:
                    if w not in counts:
                        counts[w] = 0
            else:
                counts.update(words)
            if len(counts) > FLUSH:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all words of ``docs`` (held_out, text); c counts training texts."""
    rows = docs.select("held_out", text_bytes().alias("text")).mapInArrow(_word_counts, "word binary, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


def _spelled(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner, ending = load_pieces(path)
        longest = max(map(len, [*inner, *ending]))
        counts: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                counts.update(spell(word, inner, ending, longest))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int32()), pa.array(counts.values(), pa.int64())], ["piece", "n"])

    return count


def train(words: DataFrame, n_docs: int, path: str) -> dict:
    """The model of a written (word, c) table: totals and the log score of each piece."""
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    spelled = words.filter("c > 0").select("word").mapInArrow(_spelled(path), "piece int, n long")
    # one row per piece of the vocabulary
    pieces = {r["piece"]: r["n"] for r in spelled.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    inner, ending = load_pieces(path)
    size = max([*inner.values(), *ending.values()]) + 1
    weight = np.full(size, FLOOR)
    for i, k in pieces.items():
        weight[i] += DISCOUNT * k
    total = n - DISCOUNT * v + weight.sum() + n_docs + END_FLOOR
    return {
        "train_tokens": n + n_docs, "types": v + (n_docs > 0), "docs": n_docs, "total": float(total),
        "piece": np.log(weight / total), "end": math.log((n_docs + END_FLOOR) / total),
    }


def word_scores(words: DataFrame, model: dict, path: str) -> DataFrame:
    """(word, c, log10 probability) for every word of a (word, c) table."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_inner, ids_ending = load_pieces(path)
        piece = model["piece"].tolist()
        inner, ending = ({p: piece[i] for p, i in ids.items()} for ids in (ids_inner, ids_ending))
        longest = max(map(len, [*inner, *ending]))
        log_total = math.log(model["total"])
        for batch in batches:
            out = [
                log_probability(w, math.log(c - DISCOUNT) - log_total if c else None, inner, ending, longest)
                for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(out) / math.log(10))], ["word", "c", "score"])

    return words.select("word", "c").mapInArrow(score, "word binary, c long, score double")


# --------------------------------------------------------------------- scoring


def _head(scored: DataFrame) -> tuple[pa.Table, int]:
    """The most frequent words, at most ``HEAD_WORDS``, and the least count among them."""
    levels = scored.filter("c > 0").groupBy(F.floor(F.log2("c") * 4).alias("level")).count().orderBy(F.desc("level")).collect()
    least, total = 1, 0
    for r in levels:
        total += r["count"]
        if total > HEAD_WORDS:
            least = math.ceil(2 ** ((r["level"] + 1) / 4))
            break
    return scored.filter(F.col("c") >= least).toArrow(), least


_SCORED = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
    "tail array<struct<word: binary, n: long>>"
)
_TAIL = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def _score_documents(head: pa.Table, model: dict):
    words, counts, scores = head["word"].to_pylist(), head["c"].to_numpy(), head["score"].to_numpy()
    base = np.log10(counts + 0.5) - _base_total(model)
    end = (1 if model["docs"] else 0, math.log10(model["docs"] + 0.5) - _base_total(model), model["end"] / math.log(10))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(words)}
        unknown = len(words)
        row = TaskContext.get().partitionId() << 40
        by_base, by_score = np.append(base, 0.0), np.append(scores, 0.0)
        for batch in batches:
            out = []
            for key, held_out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = (text.as_py() or b"").lower().split()
                at = np.fromiter((index.get(w, unknown) for w in found), np.int64, len(found))
                rest = Counter([found[i] for i in np.flatnonzero(at == unknown)])
                known = len(found) - int((at == unknown).sum())
                out.append((
                    row, key, held_out, len(found) + 1, known + end[0], float(by_base[at].sum()) + end[1], float(by_score[at].sum()) + end[2],
                    [{"word": w, "n": n} for w, n in rest.items()],
                ))
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), _TAIL)
            names = ["row_id", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail"]
            for i in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 2000]), kinds)], names)

    return score


def _base_total(model: dict) -> float:
    return math.log10(model["train_tokens"] + 0.5 * (model["types"] + 1))


def score_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text), learned from its training folds."""
    path = path or tokens.tokenizer_path()
    docs = small_batches(docs).select("doc_id", "text", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"))
    words = written(word_counts(docs), "words")
    model = train(words, docs.filter("not held_out").count(), path)
    scored = written(word_scores(words, model, path), "word-scores")
    head, least = _head(scored)
    rows = docs.select("doc_id", "held_out", text_bytes().alias("text")).mapInArrow(_score_documents(head, model), _SCORED)
    rows = written(rows, "rows")
    tail = rows.select("row_id", F.explode("tail").alias("t")).select("row_id", "t.word", "t.n")
    base = F.log10(F.col("c") + 0.5) - F.lit(_base_total(model))
    # words beyond the head are rare, so no key of this join is hot
    sums = tail.join(scored.filter(F.col("c") < least), "word").groupBy("row_id").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("t_known"),
        F.sum(F.col("n") * base).alias("t_base"), F.sum(F.col("n") * F.col("score")).alias("t_score"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.drop("tail").join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("t_known")).alias("n_known"),
        F.lit(model["train_tokens"]).cast("long").alias("train_tokens"),
        (F.col("base_score") + zero("t_base")).alias("base_score"), (F.col("score") + zero("t_score")).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
