"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from barsmith.paths import delete_path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "barsmith") -> SparkSession:
    """Local-mode session for tests and the bench (no UI, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the series pass is CPU-bound per shuffled byte (narrow bars widen into
        # ~60 columns across the window levels): aim for smaller partitions so a
        # small shuffle still yields several tasks per core
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        # joins on (ticker, trade_date) between sides already hashed by ticker
        # (the reference-shaped join forms) may reuse that partitioning instead
        # of re-shuffling: a ticker's rows are bounded by the calendar
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.driver.memory", os.environ.get("BARSMITH_DRIVER_MEMORY", "8g"))
        # no per-Column Python call-site capture (error-message context only):
        # it costs ~5 py4j round trips per Column function while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch folder (``spark.checkpoint.dir``).

    Read from the session; only when nothing is configured (local tests) a
    private temporary folder is created and registered as the checkpoint dir.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="barsmith-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)  # the conf itself is static
    return folder


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a DataFrame to the shared folder and reads it back
    (computed once, lineage cut); what it wrote goes when the block ends."""
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        delete_path(spark, folder)
