"""Exact duplicates by merged counting quotient filters and byte verification.

1. Each text gets a fingerprint of ``FINGERPRINT_BITS`` bits. Every partition puts its
   own into counting quotient filters (``quotient.py``), cut into slices of the
   fingerprint space; a group of copies is one slot with a counter in each filter.
2. Filters of a slice merge by their sorted remainders. Slots counted more than once are
   the fingerprints that may belong to copies. They mark a bit map of bounded size.
3. Texts whose bit is set are routed to byte verification: rows are aggregated by
   (fingerprint, text) before the exchange, so a text travels at most once per task, and
   only equal bytes make a group. A set bit without copies costs traffic, nothing else.
4. Members find their group by fingerprint and SHA-256. Groups of more than a thousandth
   of all rows are fewer than a thousand and are broadcast; the others are joined.

Of equal texts the row with the largest ``doc_id`` stays; of rows that agree in it, too,
one. Edge cases: a null text counts as empty; a null ``doc_id`` is smaller than any other
and ``keep_id`` is null only where all of a group's are. Texts are compared whole. Other
columns, whatever their names, are ignored (``keep_last`` passes them through). An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import quotient
from barsmith.llm.common import documents, join_groups, shuffle_partitions, written

FINGERPRINT_BITS = 60
SLICE_ROWS = 1 << 18  # rows per slice of the fingerprint space, at most on average
FILTER_ROWS = 1 << 20  # fingerprints put into a filter at a time
FILTER_SLOTS = 1 << 22  # slots at which a partition's filter is handed on and a new one begun
MAP_WORDS = 1 << 20  # 64-bit words of the bit map, at most; it is broadcast

_FILTERS = pa.schema([("slice", pa.int32()), ("filter", pa.binary())])


def fingerprint(text: Column, bits: int = FINGERPRINT_BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def _sliced(slice_bits: int, bits: int):
    rest = bits - slice_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        slots, counts, queue, held = none, none, [], 0

        def absorb():
            nonlocal slots, counts, queue, held
            found, n = quotient.counted(np.concatenate([none, *queue]))
            slots, counts = quotient.counted(np.concatenate([slots, found]), np.concatenate([counts, n]))
            queue, held = [], 0

        def segments():
            nonlocal slots, counts
            at = slots >> rest
            cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else none
            ends = np.append(cuts[1:], len(at))
            packed = [quotient.pack(slots[a:b] & ((1 << rest) - 1), counts[a:b], rest) for a, b in zip(cuts, ends)]
            if packed:
                yield pa.RecordBatch.from_arrays([pa.array(at[cuts], pa.int32()), pa.array(packed, pa.binary())], schema=_FILTERS)
            slots, counts = none, none

        for batch in batches:
            queue.append(batch.column(0).to_numpy(zero_copy_only=False))
            held += batch.num_rows
            if held >= FILTER_ROWS:
                absorb()
                if len(slots) >= FILTER_SLOTS:
                    yield from segments()
        absorb()
        yield from segments()

    return build


def _merged(rest: int):
    def merge(key, table):
        return pa.table({"slice": [key[0].as_py()], "filter": [quotient.merge(table.column("filter").to_pylist(), rest)]}, schema=_FILTERS)

    return merge


def _repeated(rest: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, counts = quotient.unpack(data, rest)
                many = counts > 1
                yield pa.RecordBatch.from_arrays([pa.array((at << rest) | found[many], pa.int64()), pa.array(counts[many], pa.int64())], ["fingerprint", "n"])

    return read


def partition_filters(fingerprints: DataFrame, slice_bits: int, bits: int = FINGERPRINT_BITS) -> DataFrame:
    """(slice, filter) of the one long column of ``fingerprints``, built per partition."""
    return fingerprints.mapInArrow(_sliced(slice_bits, bits), "slice int, filter binary")


def merged_filters(filters: DataFrame, slice_bits: int, bits: int = FINGERPRINT_BITS) -> DataFrame:
    """One filter per slice; a slice's filters hold about ``SLICE_ROWS`` slots together."""
    return filters.groupBy("slice").applyInArrow(_merged(bits - slice_bits), "slice int, filter binary")


def repeated(filters: DataFrame, slice_bits: int, bits: int = FINGERPRINT_BITS) -> DataFrame:
    """(fingerprint, n) of the fingerprints that merged filters count more than once."""
    return filters.mapInArrow(_repeated(bits - slice_bits), "fingerprint long, n long")


def _bit_map(repeats: DataFrame, words: int) -> DataFrame:
    """(word, bits) of at most ``words`` rows: the bits of the given fingerprints."""
    mark = F.expr("shiftleft(1L, cast(fingerprint & 63 as int))")
    return repeats.groupBy(_word(words).alias("word")).agg(F.bit_or(mark).alias("bits"))


def _word(words: int) -> Column:
    return F.shiftright("fingerprint", 6).bitwiseAND(F.lit(words - 1).cast("long"))


def _marked(rows: DataFrame, bit_map: DataFrame, words: int) -> DataFrame:
    """The rows whose fingerprint's bit is set; the map's rows are bounded by ``words``."""
    found = rows.withColumn("word", _word(words)).join(F.broadcast(bit_map), "word")
    return found.filter("shiftright(bits, cast(fingerprint & 63 as int)) & 1 = 1").drop("word", "bits")


def grouped(docs: DataFrame, bits: int = FINGERPRINT_BITS, row: Column | None = None) -> DataFrame:
    """One row per document: (row, doc_id, keep_id, group_size, kept, text_sha256).

    ``row`` numbers the documents; without it they are numbered here.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.monotonically_increasing_id() if row is None else row).alias("row"), text.alias("text"))
    rows = rows.withColumn("fingerprint", fingerprint(F.col("text"), bits))
    profile = written(rows.select("doc_id", "row", "fingerprint", F.unhex(F.sha2("text", 256)).alias("digest")), "exact-profile")
    total = profile.count()
    slices = max(total // SLICE_ROWS, shuffle_partitions(spark))
    slice_bits = min((slices - 1).bit_length(), bits - 1, 30)
    filters = partition_filters(profile.select("fingerprint"), slice_bits, bits)
    repeats = written(repeated(merged_filters(filters, slice_bits, bits), slice_bits, bits), "exact-repeats")

    words = min(MAP_WORDS, 1 << max(total // 8, 1).bit_length())
    bit_map = _bit_map(repeats, words)
    same = _marked(rows.select("doc_id", "text", "fingerprint"), bit_map, words).groupBy("fingerprint", "text").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
    same = same.filter("group_size > 1").select("fingerprint", F.unhex(F.sha2("text", 256)).alias("digest"), "group_size", "keep_id")
    stays = _marked(profile, bit_map, words).groupBy("fingerprint", "digest").agg(F.max(F.struct("doc_id", "row"))["row"].alias("keep_row"))
    groups = written(same.join(stays, ["fingerprint", "digest"]), "exact-groups")

    members = join_groups(profile, groups, ["fingerprint", "digest"], "group_size", total)
    alone = F.col("group_size").isNull()
    return members.select(
        "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_last(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")), "exact-documents")
    verdicts = grouped(rows.select("row", "doc.doc_id", "doc.text"), row=F.col("row"))
    stays = rows.join(verdicts.filter("kept").select("row"), "row", "left_semi")
    return stays.select(*(F.col(f"doc.`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(documents(spark, sf_dir)).drop("row")


SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
copies AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
SELECT t.doc_id, c.keep_id, c.group_size, t.doc_id = c.keep_id AS kept, sha256(t.body) AS text_sha256
FROM texts t JOIN copies c ON t.body = c.body
"""
