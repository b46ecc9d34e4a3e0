"""Language identification of mixed-language text.

Each word gets a score per language from a naive Bayes model over byte n-grams
(2 to 4 bytes, hashed). The scripts of its letters, told apart by code point
ranges, narrow the candidate languages to those that use one of these scripts in
the training text. A Viterbi pass over the words with a penalty for each switch
of language labels spans; the document's language is the one whose spans hold the
most bytes of words with letters, its score that share (0 to 1).

The model is fitted on at most about ``LANGUAGE_ROWS`` labelled rows of each
language, chosen by a hash of ``doc_id``; it reads nothing of a text but the text
itself when it predicts.

Edge cases: null texts and texts without a letter get ``und`` with score 0. Texts
whose letters all belong to scripts that no learned language uses get the first
label with score 0. Null labels aren't learned from; rows without a ``doc_id`` are
sampled by their place in the table. Without any labelled row everything is ``und``.
Ties between languages go to the smaller label by code point. Blanks lie between the
texts of a batch and no n-gram reaches over them, so rows are judged one by one and
repeated rows agree; other columns are untouched. Texts of any length are scored
whole: long ones in pieces, between which the Viterbi pass hands on its state.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import ASCII_SPACE, documents, give_back, in_fold, small_batches, text_bytes

LANGUAGE_ROWS = 5_000  # labelled rows of a language that the model is fitted on, about
FOLDS, HELD_OUT = 5, 0  # a null doc_id is in no fold: learned from
SLOT_BITS = 17
ORDERS = (2, 3, 4)
CONTEXT = max(ORDERS) - 1  # bytes before its last one that an n-gram reaches back
SWITCH_PENALTY = 8.0  # nats
OUTSIDE = -20.0  # score of a word in a language that doesn't use its scripts
SCRIPT_SHARE = 0.001  # a language uses a script with at least this share of its letters
SEGMENT = 64  # words per step-wise pass; longer texts are joined from segments
GROUP_BYTES = 1 << 20
STATE_BYTES = 32 << 20  # bound of back pointers: a label squared for each word

# First and last code points of scripts (Unicode blocks).
SCRIPT_RANGES = (
    ("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F))),
)
N_SCRIPTS = len(SCRIPT_RANGES)


def _ranges() -> tuple[np.ndarray, np.ndarray]:
    """Sorted starts of ranges and the script bit from each start on (0 between ranges)."""
    edges: list[tuple[int, int]] = [(0, 0)]
    for bit, (_, ranges) in enumerate(SCRIPT_RANGES):
        for first, last in ranges:
            edges += [(first, 1 << bit), (last + 1, 0)]
    merged: dict[int, int] = {}
    for at, bits in edges:
        merged[at] = merged.get(at, 0) | bits
    starts = sorted(merged)
    return np.array(starts, np.int64), np.array([merged[s] for s in starts], np.uint32)


_STARTS, _BITS_FROM = _ranges()
_ASCII_BITS = _BITS_FROM[np.searchsorted(_STARTS, np.arange(128), "right") - 1]
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def script_bits(data: np.ndarray) -> np.ndarray:
    """Script bit of the character that starts at each byte (0: no letter of a known script)."""
    bits = np.zeros(len(data), np.uint32)
    ascii_ = data < 128
    bits[ascii_] = _ASCII_BITS[data[ascii_]]
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
        b0, b1, b2, b3 = (padded[lead + k] for k in range(4))
        point = np.where(
            b0 < 0xE0, (b0 & 0x1F) << 6 | b1 & 0x3F,
            np.where(b0 < 0xF0, (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F,
                     (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F))
        bits[lead] = _BITS_FROM[np.searchsorted(_STARTS, point, "right") - 1]
    return bits


def slots(data: np.ndarray) -> list[np.ndarray]:
    """Model slot of the n-gram that ends at each byte, one array per order."""
    d = data.astype(np.uint32)
    out = []
    for n in ORDERS:
        packed = np.full(len(d), n, np.uint32) * np.uint32(0x61C88647)
        gram = np.zeros(len(d), np.uint32)
        for back in range(n):
            shifted = np.full(len(d), 32, np.uint32)
            shifted[back:] = d[: len(d) - back]
            gram |= shifted << np.uint32(8 * back)
        packed ^= gram * np.uint32(0x9E3779B1)
        packed ^= packed >> np.uint32(15)
        packed *= np.uint32(0x85EBCA6B)
        out.append((packed >> np.uint32(32 - SLOT_BITS)).astype(np.int32))
    return out


# ------------------------------------------------------------------ training


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, slot, n); slots from 2^SLOT_BITS on count letters by script."""
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, item in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = item.as_py()
            if not text:
                continue
            counts = found.setdefault(lang, np.zeros((1 << SLOT_BITS) + N_SCRIPTS, np.int64))
            for at in range(0, len(text), GROUP_BYTES):
                data = _FOLD[np.frombuffer(text[at : at + GROUP_BYTES], np.uint8)]
                for s in slots(data):
                    np.add.at(counts, s, 1)
                bits = script_bits(data)
                for k in range(N_SCRIPTS):
                    counts[(1 << SLOT_BITS) + k] += int((bits >> k & 1).sum())
    for lang, counts in found.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])], ["lang", "slot", "n"])
    give_back()


def sample(docs: DataFrame, language_rows: int = LANGUAGE_ROWS) -> DataFrame:
    """(lang, text) of about ``language_rows`` labelled rows of each language; all of a rarer one."""
    labelled = docs.filter("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), -1 - F.monotonically_increasing_id())).alias("_h"))
    # a row per language: the model holds far more for each
    sizes = docs.filter("lang is not null and text is not null").groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n"))
    share = F.col("_h").bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)
    drawn = labelled.join(F.broadcast(sizes), F.col("lang") == F.col("_lang")).filter(share * F.col("_n") < language_rows)
    return drawn.select("lang", "text")


def fit(docs: DataFrame, language_rows: int = LANGUAGE_ROWS) -> dict:
    """The model of the labelled rows of ``docs`` (columns doc_id, text, lang)."""
    counts = sample(docs, language_rows).select("lang", text_bytes().alias("text")).mapInArrow(_counts, "lang string, slot int, n long")
    table = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table["lang"].to_pylist()), key=str.encode)
    size = 1 << SLOT_BITS
    grid = np.zeros((len(langs), size + N_SCRIPTS))
    row = {lang: i for i, lang in enumerate(langs)}
    who = np.array([row[x] for x in table["lang"].to_pylist()], np.int64)
    grid[who, table["slot"].to_numpy()] = table["n"].to_numpy()
    grams, letters = grid[:, :size], grid[:, size:]
    score = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * size))
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=1, keepdims=True), 1)
    return {"langs": langs, "score": np.ascontiguousarray(score.T.astype(np.float32)), "uses": uses & (letters > 0)}


# ---------------------------------------------------------------- prediction


BLANKS = np.full(CONTEXT, 32, np.uint8)


def group_bytes(model: dict) -> int:
    """Bytes of text that are labelled together: fewer for many languages."""
    return max(1 << 12, min(GROUP_BYTES, STATE_BYTES // max(len(model["langs"]), 1) ** 2))


def word_scores(data: np.ndarray, model: dict, before: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, bytes if it has letters of a learned script, scores per language) of each word.

    ``before`` are the ``CONTEXT`` bytes in front of ``data``, the last one a blank. N-grams
    that end at a word's bytes or at the blank behind it count for the word.
    """
    space = data == 32
    first = np.flatnonzero(~space & np.append(True, space[:-1]))
    langs = len(model["langs"])
    scores = np.zeros((len(first), langs), np.float32)
    bits, size = np.zeros(len(first), np.uint32), np.zeros(len(first), np.int64)
    if not len(first):
        return first, size, scores
    padded = np.concatenate([before, data])
    step = group_bytes(model)
    for at in range(0, len(data), step):  # a word may reach over several steps
        end = min(at + step, len(data))
        lo = max(int(np.searchsorted(first, at, "right")) - 1, 0)
        hi = int(np.searchsorted(first, end))
        if lo == hi:
            continue
        part = padded[at : end + CONTEXT]
        total = np.zeros((end - at, langs), np.float32)
        for s in slots(part):
            total += model["score"][s[CONTEXT:]]
        total /= len(ORDERS)  # n-grams of several orders tell much the same
        blank = part == 32
        total[blank[CONTEXT:] & blank[CONTEXT - 1 : -1]] = 0.0
        starts = np.maximum(first[lo:hi] - at, 0)
        scores[lo:hi] += np.add.reduceat(total, starts, axis=0)
        bits[lo:hi] |= np.bitwise_or.reduceat(script_bits(data[at : end + 3])[: end - at], starts)
        size[lo:hi] += np.add.reduceat((~space[at:end]).astype(np.int64), starts)
    scores -= scores.max(axis=1, keepdims=True)
    kinds, of = np.unique(bits, return_inverse=True)
    shift = np.zeros((len(kinds), langs), np.float32)
    told = np.zeros(len(kinds), bool)
    for k, mask in enumerate(kinds.tolist()):
        allowed = np.array([any(mask >> b & 1 and model["uses"][x, b] for b in range(N_SCRIPTS)) for x in range(langs)])
        told[k] = allowed.any()
        if told[k]:
            shift[k, ~allowed] = OUTSIDE
    scores += shift[of]
    scores[~told[of]] = 0.0  # no letters of a learned script: any language
    return first, np.where(told[of], size, 0), scores


def viterbi(scores: np.ndarray, first_word: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word, for texts whose words lie one after the other.

    ``first_word`` has each text's first word. Texts are cut into segments of
    ``SEGMENT`` words; every segment is passed through from each possible entry
    label at once, then the segments of a text are joined. Exact: the same labels
    as one pass over each text.
    """
    return viterbi_piece(scores, first_word, penalty)[0]


def viterbi_piece(scores: np.ndarray, first_word: np.ndarray, penalty: float, state_before: np.ndarray | None = None, leave_by: int | None = None) -> tuple[np.ndarray, int, np.ndarray]:
    """``viterbi``; of a single text also the label before it and the score of each label at its end.

    A piece of a longer text has the score of each label in front of it
    (``state_before``) and the label that its last word must have (``leave_by``).
    """
    n, langs = scores.shape
    lengths = np.diff(np.append(first_word, n))
    per_text = -(-lengths // SEGMENT)
    text_of = np.repeat(np.arange(len(lengths)), per_text)
    rank = np.arange(len(text_of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = first_word[text_of] + rank * SEGMENT
    size = np.minimum(SEGMENT, lengths[text_of] - rank * SEGMENT)
    order = np.argsort(-size, kind="stable")  # lanes still running come first
    start, size = start[order], size[order]
    lanes = len(start)
    # value[lane, entry, label]: best score so far when the word before had label `entry`
    value = np.where(np.eye(langs, dtype=bool), 0.0, -np.inf)[None].repeat(lanes, 0)
    back = np.zeros((int(size.max(initial=0)), lanes, langs, langs), np.int8 if langs < 128 else np.int16)
    own = np.arange(langs, dtype=back.dtype)
    for t in range(len(back)):
        m = int(np.searchsorted(-size, -t))
        v = value[:m]
        best = v.argmax(axis=2)
        jump = np.take_along_axis(v, best[:, :, None], 2) - penalty
        stay = v >= jump
        back[t, :m] = np.where(stay, own, best[:, :, None])
        value[:m] = np.where(stay, v, jump) + scores[start[:m] + t][:, None, :]
    # join: entry label of each segment, from the best path over each text's segments
    place = np.empty(lanes, np.int64)
    place[order] = np.arange(lanes)
    seg_first = np.cumsum(per_text) - per_text
    some = np.flatnonzero(per_text)
    some = some[np.argsort(-per_text[some], kind="stable")]
    steps = int(per_text.max(initial=0))
    state = np.zeros((len(some), langs))  # any label may come before the first word
    if state_before is not None:
        state[:] = state_before
    enter = np.zeros((lanes, langs), np.int64)  # by lane: best entry for each label at its end
    for k in range(steps):
        m = int(np.searchsorted(-per_text[some], -k))
        at = place[seg_first[some[:m]] + k]
        paths = state[:m, :, None] + value[at]
        enter[at] = paths.argmax(axis=1)
        state[:m] = paths.max(axis=1)
    leave = np.zeros(lanes, np.int64)
    entry = np.zeros(lanes, np.int64)
    now = state.argmax(axis=1)
    if leave_by is not None:
        now[:] = leave_by
    for k in range(steps - 1, -1, -1):
        m = int(np.searchsorted(-per_text[some], -k))
        at = place[seg_first[some[:m]] + k]
        leave[at] = now[:m]
        now[:m] = enter[at, now[:m]]
        entry[at] = now[:m]
    labels = np.zeros(n, np.int64)
    label = leave
    for t in range(len(back) - 1, -1, -1):
        m = int(np.searchsorted(-size, -t))
        labels[start[:m] + t] = label[:m]
        label[:m] = back[t, np.arange(m), entry[:m], label[:m]]
    return labels, int(now[0]) if len(now) else 0, state[0] if len(state) else np.zeros(langs)


RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
    ]))),
])
_SPAN = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])


def _no_letter(text: bytes) -> bool:
    decode = codecs.getincrementaldecoder("utf-8")("replace").decode
    return not any(any(c.isalpha() for c in decode(text[at : at + GROUP_BYTES])) for at in range(0, len(text), GROUP_BYTES))


def _folded(text: bytes) -> np.ndarray:
    return _FOLD[np.frombuffer(text, np.uint8)]


def label_texts(texts: list[bytes], model: dict) -> pa.StructArray:
    langs = model["langs"]
    gap = b" " * CONTEXT
    joined = _folded(gap.join(texts) + gap)
    ends = np.cumsum([len(t) + CONTEXT for t in texts])
    first, weight, scores = word_scores(joined, model)
    bounds = np.searchsorted(first, np.append(0, ends))
    labels = viterbi(scores.astype(np.float64), bounds[:-1], SWITCH_PENALTY)
    text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    by_lang = np.zeros((len(texts), len(langs)))
    np.add.at(by_lang, (text_of, labels), weight)
    # spans: runs of one label within a text
    new = np.flatnonzero(np.append(True, (labels[1:] != labels[:-1]) | (text_of[1:] != text_of[:-1]))) if len(labels) else np.zeros(0, np.int64)
    return _result(texts, langs, by_lang, text_of[new], labels[new], new - bounds[text_of[new]], np.diff(np.append(new, len(labels))))


def piece_ends(text: bytes, size: int) -> list[int]:
    """Ends of parts of about ``size`` bytes, behind a blank each: no word is cut."""
    ends, end = [], 0
    while end < len(text):
        end = min(end + size, len(text))
        while end < len(text) and text[end - 1] not in ASCII_SPACE:
            found = np.flatnonzero(_folded(text[end : end + size]) == 32)
            end = end + int(found[0]) + 1 if len(found) else min(end + size, len(text))
        ends.append(end)
    return ends


def label_long(text: bytes, model: dict) -> pa.StructArray:
    """``label_texts`` of one text, in memory of a piece of it: a pass over the pieces finds
    the scores of labels between them, one back the labels inside."""
    langs = model["langs"]
    ends = piece_ends(text, group_bytes(model))
    starts = [0, *ends[:-1]]

    def piece(k: int) -> tuple[np.ndarray, np.ndarray]:
        before = np.concatenate([BLANKS, _folded(text[max(starts[k] - CONTEXT, 0) : starts[k]])])[-CONTEXT:]
        data = _folded(text[starts[k] : ends[k]])
        _, weight, scores = word_scores(np.append(data, BLANKS) if ends[k] == len(text) else data, model, before)
        return weight, scores.astype(np.float64)

    one = np.zeros(1, np.int64)
    states = [np.zeros(len(langs))]  # score of each label in front of each piece
    for k in range(len(ends)):
        _, scores = piece(k)
        state = viterbi_piece(scores, one, SWITCH_PENALTY, states[k])[2] if len(scores) else states[k]
        states.append(state - state.max())
    by_lang = np.zeros((1, len(langs)))
    leave = int(states[-1].argmax())
    runs: list[tuple[np.ndarray, np.ndarray]] = []
    for k in reversed(range(len(ends))):
        weight, scores = piece(k)
        if not len(scores):
            continue
        labels, leave, _ = viterbi_piece(scores, one, SWITCH_PENALTY, states[k], leave)
        np.add.at(by_lang[0], labels, weight)
        new = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
        runs.append((labels[new], np.diff(np.append(new, len(labels)))))
    label, length = (np.concatenate([np.zeros(0, np.int64), *[r[i] for r in reversed(runs)]]) for i in (0, 1))
    new = np.flatnonzero(np.append(True, label[1:] != label[:-1])) if len(label) else np.zeros(0, np.int64)
    start = (np.cumsum(length) - length)[new]
    return _result([text], langs, by_lang, np.zeros(len(new), np.int64), label[new], start, np.diff(np.append(start, length.sum())))


def _result(texts: list[bytes], langs: list[str], by_lang: np.ndarray, span_text: np.ndarray, label: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.StructArray:
    """``RESULT`` of texts, from bytes by label and the spans (text, label, first word, words)."""
    total = by_lang.sum(axis=1)
    share = np.where(total > 0, by_lang.max(axis=1) / np.maximum(total, 1), 0.0)
    names = np.array(langs, object)
    spans = pa.StructArray.from_arrays([pa.array(names[label], pa.string()), pa.array(start), pa.array(length)], fields=list(_SPAN))
    offsets = np.searchsorted(span_text, np.arange(len(texts) + 1)).astype(np.int32)
    predicted = names[by_lang.argmax(axis=1)]
    for i in np.flatnonzero(total == 0):  # no letter of a learned script
        if _no_letter(texts[i]):
            predicted[i] = "und"
    return pa.StructArray.from_arrays(
        [pa.array(predicted, pa.string()), pa.array(share), pa.ListArray.from_arrays(pa.array(offsets), spans)], RESULT.names)


def _unlearned(n: int) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(["und"] * n, pa.string()), pa.array([0.0] * n, pa.float64()), pa.array([[]] * n, pa.list_(_SPAN))], RESULT.names)


def label_batch(items: pa.Array, model: dict) -> pa.StructArray:
    """``RESULT`` of each text of an Arrow array of bytes, in groups of bounded size."""
    if not model["langs"] or not len(items):
        return _unlearned(len(items))
    limit = group_bytes(model)
    parts: list[pa.StructArray] = []
    texts: list[bytes] = []
    size = 0
    for item in items:
        text = item.as_py() or b""
        if texts and size + len(text) + CONTEXT > limit:
            parts.append(label_texts(texts, model))
            texts, size = [], 0
        if len(text) + CONTEXT > limit:
            parts.append(label_long(text, model))
        else:
            texts.append(text)
            size += len(text) + CONTEXT
    if texts:
        parts.append(label_texts(texts, model))
    return pa.concat_arrays(parts)


def label_udf(model: dict):
    """Column function text bytes -> ``RESULT`` struct."""

    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield label_batch(batch, model)
        give_back()

    label.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(label, RESULT)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~in_fold("doc_id", FOLDS, HELD_OUT))


def identify(docs: DataFrame, text: str | Column = "text") -> Column:
    """Language, score and spans of each row's text, learned from the training fold of ``docs``."""
    return label_udf(fit(training_rows(small_batches(docs))))(text_bytes(text))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without rows whose language can't be told: no text, no letter, or no letter
    of a script that a learned language uses (score 0)."""
    found = identify(docs)
    return docs.filter((found["lang_pred"] != "und") & (found["score"] > 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), identify(docs).alias("v")).select(
        "doc_id", "held_out", "v.lang_pred", "v.score", F.size("v.spans").cast("long").alias("n_spans"))
