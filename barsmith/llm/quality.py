"""Quality rules by distribution divergence.

Each language present in the table gets a *reference*: the histogram of
character classes over all its text, and the histogram of its common short words
(the ``COMMON_WORDS`` most frequent words of at most ``SHORT`` characters, plus one bin
for all other words). A document is compared with every reference by the
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1); its
distances are those to its nearest reference, and it fails when one of them
exceeds its limit. Minimum-length guards keep short texts from being judged by
noisy histograms.

Edge cases: a null or empty text has no words and fails the base rule. A null
``lang`` contributes to no reference but the document is judged like any other.
Without any reference (empty table, all languages null) the divergence rules
pass. Repeated rows are judged one by one; other columns are untouched. Ties
among common words go to the smaller word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from barsmith.llm.common import ASCII_SPACE, documents, give_back, small_batches, text_bytes

MIN_WORDS = 50  # base rule: fewer words fail
REPEAT_PERCENT = 50  # base rule: more words inside repeated 3-word windows fail
CHAR_MIN_BYTES = 400  # guard: shorter texts aren't judged by character classes
WORD_MIN_WORDS = MIN_WORDS  # guard: shorter texts aren't judged by common words
CHAR_LIMIT = 0.28  # Jensen-Shannon distance of character classes
WORD_LIMIT = 0.48  # Jensen-Shannon distance of common words
COMMON_WORDS = 100
SHORT = 6  # characters, of any script

SYMBOLS = b"#*$%&|<>"
N_CLASSES = 9


def _class_table() -> np.ndarray:
    """Class of each byte; UTF-8 continuation bytes get a class that is left out."""
    table = np.full(256, 8, np.uint8)  # other printable and control characters
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[0xC0:] = 2  # lead byte of a character beyond ASCII
    table[ord("0") : ord("9") + 1] = 3
    for b in ASCII_SPACE:
        table[b] = 4
    for b in b".,;:'\"-()":
        table[b] = 5
    for b in b"!?":
        table[b] = 6
    for b in SYMBOLS:
        table[b] = 7
    table[0x80:0xC0] = N_CLASSES
    return table


CLASS_OF = _class_table()
_CONTINUATION = bytes(range(0x80, 0xC0))
_NOT_IN_WORDS = ASCII_SPACE + _CONTINUATION


def char_histogram(text: bytes) -> np.ndarray:
    counts = np.zeros(N_CLASSES, np.int64)
    step = 1 << 20  # keeps the expanded index array small for very long texts
    for at in range(0, len(text), step):
        part = CLASS_OF[np.frombuffer(text[at : at + step], np.uint8)]
        counts += np.bincount(part, minlength=N_CLASSES + 1)[:N_CLASSES]
    return counts


def js_distance(p: np.ndarray, q: np.ndarray, unseen: np.ndarray | float = 0.0) -> np.ndarray:
    """Distance of distributions along the last axis.

    ``unseen`` is the reference mass in bins left out of both arrays because the
    document has nothing there; each such unit of mass adds half a bit.
    """
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=-1)
    return np.sqrt(np.clip((left + right + unseen) / 2, 0.0, 1.0))


_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice (all occurrences count)."""
    n = len(hashes) - 2
    if n < 2:
        return 0
    windows = hashes[:n] * _MUL[0] + hashes[1 : n + 1] * _MUL[1] + hashes[2:] * _MUL[2]
    s = np.sort(windows)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    again = twice[np.minimum(np.searchsorted(twice, windows), len(twice) - 1)] == windows
    covered = np.zeros(n + 2, bool)
    covered[:n] |= again
    covered[1 : n + 1] |= again
    covered[2:] |= again
    return int(covered.sum())


def base_features(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(text.translate(None, _NOT_IN_WORDS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
    )


# ---------------------------------------------------------------- references

_STATS = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("word", T.BinaryType()),  # null: a row of character classes and word totals
    T.StructField("n", T.LongType()),
    T.StructField("chars", T.ArrayType(T.LongType())),
])
_FLUSH = 200_000  # distinct words held per task before they are handed on


def is_short(word: bytes) -> bool:
    """Whether a word has at most ``SHORT`` characters (of up to four bytes each)."""
    return len(word) <= SHORT or (len(word) <= 4 * SHORT and len(word.translate(None, _CONTINUATION)) <= SHORT)


def _language_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64()), ("chars", pa.list_(pa.int64()))])
    words: dict[str, Counter] = {}
    chars: dict[str, np.ndarray] = {}
    totals: Counter = Counter()

    def flush():
        rows = [(lang, w, n, None) for lang, c in words.items() for w, n in c.items()]
        rows += [(lang, None, totals[lang], chars[lang].tolist()) for lang in chars]
        words.clear(), chars.clear(), totals.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if lang is None or not text:
                continue
            found = text.lower().split()
            words.setdefault(lang, Counter()).update(filter(is_short, found))
            totals[lang] += len(found)
            chars[lang] = chars.get(lang, 0) + char_histogram(text)
        if sum(map(len, words.values())) > _FLUSH:
            yield from flush()
    yield from flush()
    give_back()


def references(docs: DataFrame) -> DataFrame:
    """One row per language: ``lang``, ``chars`` (class counts), ``n_words`` and
    ``common`` (array of (word, n), the most frequent short words)."""
    stats = docs.select("lang", text_bytes().alias("text")).mapInArrow(_language_stats, _STATS)
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = (
        stats.filter("word is not null")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
        # distinct words of at most SHORT characters per language is ranked here
        .withColumn("r", F.row_number().over(top)).filter(F.col("r") <= COMMON_WORDS)
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "word", "n"))).alias("common"))
    )
    chars = stats.filter("word is null").groupBy("lang").agg(
        F.sum("n").alias("n_words"),
        F.array(*[F.sum(F.col("chars")[i]) for i in range(N_CLASSES)]).alias("chars"),
    )
    return chars.join(common, "lang", "left")


def load_references(docs: DataFrame) -> dict:
    """The references as plain arrays: one entry per language, ``COMMON_WORDS`` words each."""
    rows = sorted(references(docs).collect(), key=lambda r: r["lang"].encode())
    vocabulary = sorted({bytes(x["word"]) for r in rows for x in r["common"] or []})
    at = {w: i for i, w in enumerate(vocabulary)}
    words = np.zeros((len(rows), len(vocabulary) + 1))
    own = np.zeros((len(rows), len(vocabulary) + 1), bool)
    for k, r in enumerate(rows):
        for x in r["common"] or []:
            words[k, at[bytes(x["word"])]] = x["n"]
            own[k, at[bytes(x["word"])]] = True
        words[k, -1] = r["n_words"] - words[k].sum()
    return {"langs": [r["lang"] for r in rows], "chars": np.array([r["chars"] for r in rows], float).reshape(len(rows), N_CLASSES),
            "vocabulary": vocabulary, "words": words, "own": own}


# ------------------------------------------------------------------- verdict

VERDICT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
       T.StructField("char_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType())]
)


class _Judge:
    """The references as distributions, ready to compare texts with."""

    def __init__(self, ref: dict):
        self.index = {w: i for i, w in enumerate(ref["vocabulary"])}
        self.chars = ref["chars"] / ref["chars"].sum(axis=1, keepdims=True)
        self.words = ref["words"] / np.maximum(ref["words"].sum(axis=1, keepdims=True), 1.0)
        self.own = ref["own"]

    def char_distance(self, text: bytes) -> float:
        counts = char_histogram(text)
        return float(js_distance(counts / counts.sum(), self.chars).min())

    def word_distance(self, words: list[bytes]) -> float:
        found = Counter(filter(self.index.__contains__, words))
        at = np.fromiter((self.index[w] for w in found), np.int64, len(found))
        p = np.fromiter(found.values(), float, len(found)) / len(words)
        own = self.own[:, at]  # a language's bins are its own common words and one for the rest
        p = np.where(own, p, 0.0)
        q = np.where(own, self.words[:, at], 0.0)
        rest = 1.0 - p.sum(axis=1, keepdims=True)
        its_rest = self.words[:, -1:]
        unseen = 1.0 - its_rest[:, 0] - q.sum(axis=1)
        both = js_distance(np.hstack([p, rest]), np.hstack([q, its_rest]), unseen)
        return float(both.min())


def verdict_udf(ref: dict):
    """Column function text bytes -> ``VERDICT`` struct, judged against ``ref``."""

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge_by = _Judge(ref) if ref["langs"] else None
        for batch in batches:
            rows = []
            for item in batch:
                text = item.as_py() or b""
                words = text.split()
                n = len(words)
                hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
                features = base_features(text, words, hashes)
                failed = n < MIN_WORDS or 100 * features[3] > REPEAT_PERCENT * n
                by_char = by_word = None
                if judge_by:
                    if len(text) >= CHAR_MIN_BYTES:
                        by_char = judge_by.char_distance(text)
                    if n >= WORD_MIN_WORDS:
                        by_word = judge_by.word_distance(text.lower().split())
                diverges = (by_char is not None and by_char > CHAR_LIMIT) or (by_word is not None and by_word > WORD_LIMIT)
                rows.append((n, *features, failed, not (failed or diverges), by_char, by_word))
            columns = list(zip(*rows)) or [()] * len(VERDICT)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], VERDICT.names)
        give_back()

    judge.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(judge, VERDICT)


def verdict(docs: DataFrame, text: str | Column = "text") -> Column:
    """The verdict on each row's text against the references of ``docs``."""
    return verdict_udf(load_references(small_batches(docs)))(text_bytes(text))


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows the rules reject; all columns as they were."""
    return docs.filter(verdict(docs)["kept"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", verdict(docs).alias("v")).select("doc_id", "v.*")
