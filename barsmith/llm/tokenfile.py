"""Token-id files: documents' ids in entropy-coded, independent blocks.

Documents are put in ascending ``doc_id`` order by a range exchange. Each part
concatenates its documents' ids (an end id after each) and cuts them into blocks of
``BLOCK_IDS`` ids, which ``idcoder`` codes. A file is a Parquet table with one row
per block::

    part        int            range part, ascending in doc_id
    block       int            from 0 in each part
    first_row   long           number in the part of the first document in the block
    doc_ids     array<long>    documents with ids in the block, in order
    n_ids       array<long>    how many of each
    payload     binary         the coded block (header with two checksums, code)

A block can be read by itself: nothing but its row is needed. Reading returns the
documents with their global position; a document that spans blocks is joined by
combining its parts' checksums.

Edge cases: a null or empty text is the end id alone. Null ``doc_id``s come first.
Repeated ``doc_id``s are documents of their own, ordered by text. Other columns are
ignored. An empty table gives an empty file and no rows. A damaged block raises.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm import idcoder, tokens
from barsmith.llm.common import documents, scratch, shuffle_partitions, small_batches, text_bytes

END_ID = 2
BLOCK_IDS = 4096
LANES = 1536  # blocks coded side by side in a task; bounds its memory

FILE = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("first_row", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("n_ids", T.ArrayType(T.LongType())),
    T.StructField("payload", T.BinaryType()),
])
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_row", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.list_(pa.int64())), ("payload", pa.binary())])


def _coded_blocks(path: str, end_id: int, block_ids: int, lanes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u2")
        queue: list[np.ndarray] = []  # ids not coded yet, one array per document (or rest of one)
        keys: list[int | None] = []
        held = row = block = 0

        def flush(last: bool):
            nonlocal held, row, block, queue, keys
            n = held if last else held - held % block_ids
            if not n:
                return
            ids = np.concatenate(queue)
            cuts = [ids[i : min(i + block_ids, n)] for i in range(0, n, block_ids)]
            payloads = idcoder.encode_blocks(cuts)
            ends = np.cumsum([len(x) for x in queue])
            starts = ends - [len(x) for x in queue]
            rows = []
            for k, (cut, payload) in enumerate(zip(cuts, payloads)):
                lo = k * block_ids
                hi = lo + len(cut)
                a, b = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(starts, hi))
                parts = np.minimum(ends[a:b], hi) - np.maximum(starts[a:b], lo)
                rows.append((part, block + k, row + a, keys[a:b], parts.tolist(), payload))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
            done = int(np.searchsorted(ends, n, "right"))
            rest = ids[n:]
            block += len(cuts)
            row += done
            keys = keys[done:]
            queue = [rest[max(int(s) - n, 0) : int(e) - n] for s, e in zip(starts[done:], ends[done:])]
            held -= n

        for docs, found in tokens.encoded_groups(batches, path):
            for key, ids in zip(docs, found):
                queue.append(np.concatenate([ids, end]))
                keys.append(key)
                held += len(queue[-1])
                if held >= lanes * block_ids:
                    yield from flush(False)
        yield from flush(True)

    return write


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS, lanes: int = LANES) -> None:
    """Write the ids of ``docs`` (doc_id, text) as a token-id file at ``path``."""
    parts = shuffle_partitions(docs.sparkSession)
    rows = small_batches(docs).select("doc_id", text_bytes().alias("text"))
    rows = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    coded = rows.mapInArrow(_coded_blocks(tokenizer or tokens.tokenizer_path(), end_id, block_ids, lanes), FILE)
    coded.write.option("compression", "uncompressed").parquet(path)


# ------------------------------------------------------------------- reading

_PIECES = "part int, row long, doc_id long, block int, start long, n long, crc long"


def _decoded(block_ids: int, lanes: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, lanes):
                some = batch.slice(at, lanes)
                found = idcoder.decode_blocks(some.column(5).to_pylist())
                rows = []
                for part, block, first, keys, sizes, ids in zip(*(some.column(k).to_pylist() for k in range(5)), found):
                    start = 0
                    for k, (key, n) in enumerate(zip(keys, sizes)):
                        rows.append((part, first + k, key, block, block * block_ids + start, n, zlib.crc32(ids[start : start + n].tobytes())))
                        start += n
                    if start != len(ids):
                        raise ValueError("index and block disagree")
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "row", "doc_id", "block", "start", "n", "crc"])

    return read


# Checksums of concatenations: crc(a + b) is crc(a) times x^(8 |b|) modulo the CRC
# polynomial, plus crc(b). Polynomials over GF(2) are held bit-reversed.
_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    out, bit = 0, 1 << 31
    while a:
        if a & bit:
            out ^= b
            a ^= bit
        bit >>= 1
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
    return out


@lru_cache(4096)
def _shift(n: int) -> int:
    """x^(8 n) modulo the polynomial."""
    out, square = 1 << 31, 1 << 23  # 1 and x^8
    while n:
        if n & 1:
            out = _times(out, square)
        square = _times(square, square)
        n >>= 1
    return out


def crc32_concat(first: int, second: int, second_bytes: int) -> int:
    return _times(_shift(second_bytes), first) ^ second


@F.arrow_udf(T.LongType())
def _joined_crc(pieces: pa.Array) -> pa.Array:
    out = []
    for doc in pieces.to_pylist():
        crc = doc[0]["crc"]
        for p in doc[1:]:
            crc = crc32_concat(crc, p["crc"], 4 * p["n"])
        out.append(crc)
    return pa.array(out, pa.int64())


def read_ids(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS, lanes: int = LANES) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in a token-id file."""
    file = spark.read.schema(FILE).parquet(path)
    pieces = file.mapInArrow(_decoded(block_ids, lanes), _PIECES)
    # a document's pieces: as many as blocks it spans
    whole = pieces.groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "crc", "n"))).alias("pieces"),
    )
    # one row per part: where it begins
    parts = file.groupBy("part").agg(F.sum(F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()
    begin, base = [], 0
    for p in sorted(parts, key=lambda r: r["part"]):
        begin.append((p["part"], base))
        base += p["n"]
    begins = spark.createDataFrame(begin, "part int, base long")
    crc = F.when(F.size("pieces") == 1, F.col("pieces")[0]["crc"]).otherwise(_joined_crc("pieces"))
    return whole.join(F.broadcast(begins), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", crc.alias("ids_crc32"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-ids")
    write_ids(documents(spark, sf_dir), path)
    return read_ids(spark, path)
