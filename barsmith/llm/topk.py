"""Exact top-k inner products by MaxScore.

A vector's dimensions are the terms, their integer values the postings. Candidates are
dealt to shards, queries to blocks; each (shard, block) pair is one task's work:

* per query, a dimension's score bound in the shard is the most that any candidate
  gains from it, its reach that bound less the least;
* a first run of candidates, scored in full, gives the threshold: the k-th best score;
* dimensions are taken by falling reach. The non-essential ones are the largest tail
  whose bounds, with the least the others may bring, stay below the threshold; the
  postings of the essential ones are traversed for all candidates;
* the others are probed a few at a time, only for candidates whose score so far and
  the bounds of what is left still reach the threshold.

The shards' best are merged per query. Equal scores go to the smaller ``vec_id`` (a
candidate that can only reach the threshold itself is still probed), so the result is
exact.

Edge cases: vectors that are null, empty or hold a null or non-finite component, and
rows without a ``vec_id``, take no part. Shorter vectors count as padded with zeros.
Rows with a query's ``vec_id`` are the query itself. Queries with fewer candidates than
k get all of them. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from barsmith.llm.common import shuffle_partitions, written

K = 5
SCALE = 256
QUERY_STEP = 50  # rows with a vec_id divisible by it are the queries
SHARD_ROWS = 8192
QUERY_ROWS = 2048
FIRST = 256  # candidates scored in full for the first threshold
PROBE = 8  # dimensions probed at a time


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, values) of the rows that take part; values are floor(scale * x)."""
    x = F.col("embedding")
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    kept = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(F.forall(x, ok))
    return kept.select("vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("values"))


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def best_of_shard(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the query's k best among rows sorted by id; all exact."""
    gain = np.maximum(query * low, query * high)
    least = np.minimum(query * low, query * high)
    order = np.argsort(-(gain - least), kind="stable")
    q = query[order]
    left = np.append(np.cumsum(gain[order][::-1])[::-1], 0)  # bounds of the dimensions from here on
    first = vectors[:FIRST] @ query
    mine = ids[:FIRST] == query_id
    first = first[~mine]
    threshold = int(np.partition(first, len(first) - k)[len(first) - k]) if len(first) >= k else None
    if threshold is None:
        alive, score, at = np.arange(len(ids)), vectors @ query, len(q)
    else:
        floor = np.append(0, np.cumsum(least[order]))
        # essential: as many leading dimensions as it takes that the rest can't make up the threshold alone
        essential = int(np.argmax(floor + left < threshold)) if (floor + left < threshold).any() else len(q)
        at = max(min(essential, len(q)), min(PROBE, len(q)))
        score = vectors[:, order[:at]] @ q[:at]
        alive = np.flatnonzero(score + left[at] >= threshold)
        score = score[alive]
    while at < len(q) and len(alive):
        end = min(at + PROBE, len(q))
        score = score + vectors[np.ix_(alive, order[at:end])] @ q[at:end]
        at = end
        keep = score + left[at] >= threshold
        alive, score = alive[keep], score[keep]
    other = ids[alive] != query_id
    alive, score = alive[other], score[other]
    top = np.lexsort((ids[alive], -score))[:k]
    return ids[alive[top]], score[top]


def _search(width: int, exact: np.dtype, k: int):
    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        if len(candidates) and len(queries):
            candidates = candidates.sort_values("vec_id", kind="stable")
            ids = candidates["vec_id"].to_numpy()
            whole = _matrix(candidates["values"], width)
            low, high = whole.min(axis=0), whole.max(axis=0)
            vectors = whole.astype(exact)
            for query_id, key, q in zip(queries["vec_id"], queries["query_key"], _matrix(queries["values"], width)):
                found, score = best_of_shard(ids, vectors, query_id, q.astype(exact), k, low.astype(exact), high.astype(exact))
                out["query_id"] += [query_id] * len(found)
                out["query_key"] += [key] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += score.astype(np.int64).tolist()
        return pd.DataFrame({c: np.array(v, np.int64) for c, v in out.items()})

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best among the other rows.

    ``vectors`` is a written table of (vec_id, values).
    """
    spark = vectors.sparkSession
    n, width, most, n_queries = vectors.agg(
        F.count("*"), F.max(F.size("values")), F.max(F.aggregate("values", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))), F.sum(is_query.cast("int")),
    ).first()
    # the narrowest type that holds every sum exactly
    bound = (width or 0) * (most or 0) ** 2
    if bound >= 1 << 63:
        raise ValueError("inner products exceed 64 bits")
    exact = np.dtype(np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64)
    shards = max(min(shuffle_partitions(spark), -(-n // FIRST)), -(-n // shard_rows), 1)
    blocks = max(1, -(-(n_queries or 0) // query_rows))
    spread = F.pmod(F.xxhash64("vec_id", "values"), F.lit(shards))
    candidates = vectors.select("vec_id", "values", spread.cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = vectors.filter(is_query).withColumn("query_key", F.xxhash64("vec_id", "values")).distinct()
    queries = queries.select(
        "vec_id", "values", "query_key", F.pmod("query_key", F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    best = candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInPandas(
        _search(width or 0, exact, k), "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = written(integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "vectors")
    return top_k(vectors, F.col("vec_id") % QUERY_STEP == 0)


SQL = """
WITH part AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM part q JOIN part c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
