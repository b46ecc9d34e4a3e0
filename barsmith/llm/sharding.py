"""Byte-balanced shards by histogram sort.

Documents are sorted by a 64-bit key: 40 bits of their text's hash, so equal texts lie
next to each other, then 24 bits of their id's hash. Shards are ranges of the key with
nearly equal bytes. The splitters between them are found by counting: candidate
boundaries are broadcast, every partition counts its bytes and rows between them,
and each splitter's bracket is probed anew until a boundary is within ``TOLERANCE`` of
a shard's share of its ideal place, or no row lies between the best two. Boundaries
between texts are tried first; a group of equal texts stays whole unless that would
miss the ideal place by more than ``GROUP_MISS`` of a share and by more than
``GROUP_ROWS`` of its rows (rows that count for at most ``ROWS_MISS`` of a share).
Then rows are exchanged once, by slices of their shard that hold about as many rows
each (found by the same probing, of row counts) and whose exact row counts give every
row its slot without a second pass.

Edge cases: a null or empty text counts no bytes of its own, every row the overhead of
``ROW_BYTES``. Null or repeated ``doc_id``s are hashed like others; rows that agree in
key are ordered by ``doc_id`` and checksum, and may share a shard only as a whole when
they agree in text and id. With fewer rows than shards, shards stay empty. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from barsmith.llm.common import documents, shuffle_partitions, text_bytes, written

SHARDS = 40
ROW_BYTES = 16
TOLERANCE = 0.005  # of a shard's share
GROUP_MISS = 0.01  # of a share: a miss that a group of equal texts isn't split for
GROUP_ROWS, ROWS_MISS = 1.5, 0.1  # likewise in rows of the group, up to that part of a share
SLICE_MISS = 0.25  # of a slice's rows
PROBES = 32  # per splitter and round
SLICE_ROWS = 200_000  # rows per slice of a shard, about
GROUP_SPAN = 1 << 24  # keys of one text-hash prefix
TOP = 1 << 64


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, size, text_crc32); the key is shifted to signed order."""
    raw = F.coalesce(text_bytes(), F.lit(b""))
    text_part = F.xxhash64("text").bitwiseAND(F.lit(-GROUP_SPAN))
    id_part = F.xxhash64("doc_id", F.lit(7)).bitwiseAND(F.lit(GROUP_SPAN - 1))
    return docs.select(
        text_part.bitwiseOR(id_part).alias("key"), "doc_id",
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
    )


def _signed(keys: list[int]) -> np.ndarray:
    """Unsigned places 0..2^64 - 1 as the signed keys that sort alike."""
    return np.array([k - (1 << 63) for k in keys], np.int64)


def _counts_between(probes: np.ndarray):
    """(interval, bytes, rows) per task; interval i holds keys from probe i - 1 up to below probe i."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column(0).to_numpy(), "right")
            np.add.at(size, at, batch.column(1).to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(size[some]), pa.array(rows[some])], ["interval", "bytes", "rows"])

    return count


def histogram(rows: DataFrame, places: list[int]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows with a key below each of the sorted places."""
    found = (
        rows.select("key", "size").mapInArrow(_counts_between(_signed(places)), "interval int, bytes long, rows long")
        .groupBy("interval").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()
    )
    size, number = [0] * (len(places) + 1), [0] * (len(places) + 1)
    for r in found:
        size[r["interval"]], number[r["interval"]] = r["bytes"], r["rows"]
    return np.cumsum(size)[:-1].tolist(), np.cumsum(number)[:-1].tolist()


def boundaries(rows: DataFrame, parts: int, by: str, tolerance: float, whole_groups: bool) -> list[int]:
    """The first key of each part but the first, as places in 0..2^64, ascending; parts have
    nearly equal totals of ``by`` (``bytes`` or ``rows``)."""
    size, number = rows.agg(F.sum("size"), F.count("*")).first()
    if not number:
        return [TOP] * (parts - 1)
    of = 1 if by == "bytes" else 2
    total = (0, size, number)[of]
    share = total / parts
    goal = [total * (j + 1) / parts for j in range(parts - 1)]
    # per boundary: (place, bytes below, rows below) at either end of its bracket
    low = [(0, 0, 0)] * len(goal)
    high = [(TOP, size, number)] * len(goal)
    chosen: list[int | None] = [None] * len(goal)
    while None in chosen:
        probes: set[int] = set()
        for j, (a, b) in enumerate(zip(low, high)):
            if chosen[j] is None:
                # between texts while the bracket spans several, then inside one
                unit = GROUP_SPAN if b[0] - a[0] > GROUP_SPAN else 1
                steps = (b[0] - a[0]) // unit
                probes.update(a[0] + unit * (steps * i // (PROBES + 1)) for i in range(1, PROBES + 1))
        places = sorted(p for p in probes if 0 < p < TOP)
        inside = list(zip(places, *histogram(rows, places)))
        between = [f for f in inside if f[0] % GROUP_SPAN == 0]
        below = {id(f): [x[of] for x in f] for f in (inside, between)}
        for j in range(len(goal)):
            if chosen[j] is not None:
                continue
            # another boundary's probes inside a text don't count before the bracket is one text
            found = between if high[j][0] - low[j][0] > GROUP_SPAN else inside
            after = bisect_right(below[id(found)], goal[j])  # probes before this one lie at or below the goal
            if after and found[after - 1][0] > low[j][0]:
                low[j] = found[after - 1]
            if after < len(found) and found[after][0] < high[j][0]:
                high[j] = found[after]
            a, b = low[j], high[j]
            best = a if goal[j] - a[of] <= b[of] - goal[j] else b
            near = tolerance * share
            if whole_groups and b[0] - a[0] == GROUP_SPAN and b[2] > a[2]:
                row = (b[of] - a[of]) / (b[2] - a[2])
                near = max(near, GROUP_MISS * share, min(GROUP_ROWS * row, ROWS_MISS * share))
            if abs(best[of] - goal[j]) <= near or b[2] - a[2] <= 1 or b[0] - a[0] <= 1:
                chosen[j] = best[0]
    return list(np.maximum.accumulate(np.array(chosen, object)))


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[int]:
    """The first key of each shard but shard 0, as places in 0..2^64; ascending."""
    return boundaries(rows, shards, "bytes", tolerance, True)


def shard(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``rows`` (a written ``keyed`` table) with ``shard`` and ``slot``, exchanged by ranges of the key."""
    cuts = [0, *splitters(rows, shards, tolerance), TOP]
    # slices of as many rows, however the keys lie; the cuts of shards are edges too
    slices = max(-(-rows.count() // slice_rows), shuffle_partitions(rows.sparkSession))
    places = sorted({*boundaries(rows, slices, "rows", SLICE_MISS, False), *cuts[1:-1]})
    places = [p for p in places if 0 < p < TOP]
    _, below = histogram(rows, places)
    edges, first_row = [0, *places], [0, *below]
    shard_of = (np.searchsorted(np.array(cuts[1:-1], object), np.array(edges, object), "right")).astype(np.int64)
    start = {}
    for s, r in zip(shard_of.tolist(), first_row):
        start.setdefault(s, r)
    base = np.array([r - start[s] for s, r in zip(shard_of.tolist(), first_row)], np.int64)
    bounds = _signed(places)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(bounds, batch.column(0).to_numpy(), "right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at.astype(np.int32)), pa.array(shard_of[at].astype(np.int32)), pa.array(base[at])],
                [*batch.schema.names, "slice", "shard", "base"])

    rows = rows.select("key", "doc_id", "size", "text_crc32")
    placed = rows.mapInArrow(locate, "key long, doc_id long, size long, text_crc32 long, slice int, shard int, base long")
    order = Window.partitionBy("slice").orderBy("key", "doc_id", "text_crc32")
    return placed.withColumn("slot", F.col("base") + F.row_number().over(order) - 1).drop("base", "slice")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(written(keyed(documents(spark, sf_dir)), "keyed")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
