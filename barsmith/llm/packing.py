"""Best-fit packing with bound-certified repacking.

Documents become token pieces of at most ``capacity`` ids; pieces are packed into
sequences of that capacity. Pieces are dealt to groups by hash, each group is
packed best-fit decreasing, and dual feasible functions give a lower bound on the
group's number of sequences. A group that meets its bound is certified: it only
gives up its emptiest sequences. A group with a gap gives up every sequence that
isn't full. What is given up is exchanged (dealt anew to fewer, mixed groups) and
packed again, until one group is left.

Edge cases: a null or empty text is the end id alone. Repeated rows and repeated or
null ``doc_id`` are documents of their own. An empty table gives no rows. Ties in
length are broken by hash, so reruns agree. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm import tokens
from barsmith.llm.common import documents, small_batches, text_bytes, written

CAPACITY = 2048
END_ID = 0
GIVE_UP = 0.1  # share of its sequences that a certified group gives up, the emptiest
OPEN_ROUNDS = 3  # from then on groups with a gap give up no more than that
GROUP_PIECES = 50_000  # pieces packed together in one group

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token pieces of every document; only longer ones are cut."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        for keys, found in tokens.encoded_groups(batches, path):
            rows = []
            for key, ids in zip(keys, found):
                ids = np.concatenate([ids.astype("<u4"), end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((key, k, at, len(part), zlib.crc32(part.tobytes())))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, PIECES.names)

    return small_batches(docs).select("doc_id", text_bytes().alias("text")).mapInArrow(pieces, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest sequences that can hold ``lengths``, by dual feasible functions.

    f_t keeps lengths between t and capacity - t, raises longer ones to the
    capacity and drops shorter ones; u_k rounds x/capacity to multiples of 1/k.
    Any packing's sum of f over a sequence is at most the capacity.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    weight = np.cumsum(count * size)  # total length up to x
    number = np.cumsum(count)
    best = 0
    t = np.arange(0, capacity // 2 + 1)
    upto, below = capacity - t, np.maximum(t - 1, 0)
    middle = weight[upto] - np.where(t > 0, weight[below], 0)
    longer = number[capacity] - number[upto]
    best = int(np.max(longer + -(-middle // capacity)))
    for k in range(1, 21):
        exact = (k + 1) * size % capacity == 0
        # in units of 1/(k * capacity): exact multiples stay, the rest round down to k-ths
        value = np.where(exact, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, int(-(-(count * value).sum() // (k * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each length (given in any order), and each sequence's room."""
    order = np.argsort(-lengths, kind="stable")
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[int] = []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by room left
    filled = 0  # bit r: some sequence has room r
    for i in order.tolist():
        n = int(lengths[i])
        fits = filled >> n
        if fits:
            left = n + ((fits & -fits).bit_length() - 1)
            s = open_[left].pop()
            if not open_[left]:
                filled ^= 1 << left
        else:
            s, left = len(room), capacity
            room.append(capacity)
        seq[i], offset[i] = s, capacity - left
        left -= n
        room[s] = left
        if left:
            open_[left].append(s)
            filled |= 1 << left
    return seq, offset, np.array(room, np.int64)


_PACKED = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("stays", T.BooleanType())])


def _pack_group(round_no: int, capacity: int, last: bool):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        seq, offset, room = best_fit_decreasing(lengths, capacity)
        given_up = np.zeros(len(room), bool)
        if not last:
            emptiest = np.argsort(-room, kind="stable")
            if len(room) == lower_bound(lengths, capacity) or round_no >= OPEN_ROUNDS:
                emptiest = emptiest[: max(1, int(GIVE_UP * len(room)))]
            given_up[emptiest] = room[emptiest] > 0
        number = (np.int64(round_no) << 56) + (np.int64(pdf["g"].iloc[0]) << 28)
        return pd.DataFrame({**{c: pdf[c] for c in PIECES.names}, "sequence_id": number + seq, "offset": offset, "stays": ~given_up[seq]})

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` is read repeatedly: hand in a written table."""
    done: list[DataFrame] = []
    todo, round_no = pieces, 0
    while True:
        n = todo.count()
        groups = max(1, -(-n // group_pieces))
        last = groups == 1
        mixed = todo.withColumn("h", F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(round_no))).withColumn("g", F.pmod("h", F.lit(groups)).cast("int"))
        packed = written(mixed.groupBy("g").applyInPandas(_pack_group(round_no, capacity, last), _PACKED), f"packed-{round_no}")
        done.append(packed.filter("stays").drop("stays"))
        if last:
            break
        todo = packed.filter("not stays").select(*PIECES.names)
        round_no += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Packed pieces of all documents."""
    return pack(written(cut(docs, path or tokens.tokenizer_path(), capacity, end_id), "pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
