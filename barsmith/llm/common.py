"""Helpers shared by the training-data operators.

Text conventions used throughout: a *word* is a maximal run of bytes other than
``\\x20`` and ``\\x09``-``\\x0D`` (exactly what ``bytes.split()`` cuts at), texts
travel to Python as UTF-8 bytes, and ``bytes.lower()`` lower-cases A-Z only.
"""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import tokens
from barsmith.session import shared_dir

BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(col: str | Column = "text") -> Column:
    """The text as UTF-8 bytes (null stays null)."""
    return F.col(col).cast("binary") if isinstance(col, str) else col.cast("binary")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with rows handed to Python in batches of at most ``BATCH_ROWS`` rows and about
    ``BATCH_BYTES`` bytes (a single longer row is a batch of its own).

    Lowers the session's settings; a bound in bytes that is set stays as it is.
    """
    conf = df.sparkSession.conf
    now = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def fold(col: str | Column, modulus: int) -> Column:
    """crc32(value as text) mod ``modulus``; null for null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(c.cast("string").cast("binary")) % modulus


def in_fold(col: str | Column, modulus: int, remainder: int) -> Column:
    """Whether the value's fold is ``remainder``; false for null."""
    return F.coalesce(fold(col, modulus) == remainder, F.lit(False))


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the cluster-shared folder.

    The folder is the session's ``spark.checkpoint.dir``. Only a local-mode
    session may go without one.
    """
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """In the block, the shuffle files of each action go when it has ended, not when the
    driver's garbage collector meets them. For actions whose plans aren't run again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


HOT_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], members: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group; null where it isn't among ``groups``.

    ``groups`` has one row per value of ``keys`` (nulls are equal) and, in ``members``,
    how many of the ``total`` rows belong to it. Groups of more than a thousandth of all
    rows are fewer than ``HOT_GROUPS`` and are broadcast, so the shuffled join only
    meets rows of small groups. Both inputs are read twice: written tables, best.
    """
    facts = [c for c in groups.columns if c not in keys]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *[F.col(c).alias(f"_f_{c}") for c in facts], F.lit(True).alias("_found"))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        return left.join(right, same, "left")

    hot = F.col(members) * HOT_GROUPS > total
    tagged = joined(rows, F.broadcast(groups.filter(hot)))
    done = tagged.filter("_found")
    rest = joined(tagged.filter("_found is null").select(*rows.columns), groups.filter(~hot))
    out = done.unionByName(rest)
    return out.select(*rows.columns, *[F.col(f"_f_{c}").alias(c) for c in facts])


MAP_WORDS = 1 << 20


def among(rows: DataFrame, key: str, wanted: DataFrame, n: int) -> DataFrame:
    """``rows`` without most of those whose ``key`` isn't among the ``n`` of ``wanted``: a
    prefilter in front of an exchange. A bit map of at most ``MAP_WORDS`` words is broadcast."""
    words = min(MAP_WORDS, 1 << max(n // 4, 1).bit_length())
    h = F.xxhash64(key)
    word, mark = F.shiftright(h, 6).bitwiseAND(F.lit(words - 1).cast("long")), F.expr(f"shiftleft(1L, cast(xxhash64(`{key}`) & 63 as int))")
    bits = wanted.groupBy(word.alias("_word")).agg(F.bit_or(mark).alias("_bits"))
    return rows.withColumn("_word", word).join(F.broadcast(bits), "_word").filter(F.col("_bits").bitwiseAND(mark) != 0).drop("_word", "_bits")


def give_back() -> None:
    """Hand memory that the allocators hold free back to the system, and what the worker keeps
    of tokenizers. Called at the end of a Python task without tokens: its worker lives on beside
    those of later stages."""
    tokens.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def require_stable_hash() -> None:
    """Raise unless ``hash(bytes)`` agrees between Python workers.

    PySpark fixes PYTHONHASHSEED for its workers; word identities that leave a
    task rely on it.
    """
    if os.environ.get("PYTHONHASHSEED", "random") == "random":
        raise RuntimeError("PYTHONHASHSEED must be fixed on the executors")
