"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source has a target number of words; at most ``MAX_REPEATS`` times its size,
what a source can't take is shared out again by weight. A source's documents are
dealt to blocks of about ``BLOCK_WORDS`` words by hash; a longer document is a block of
its own. The mix takes every block of a source as often as its target holds the whole
source, and for the rest blocks in a permuted order. Long documents are taken as far as
the target reaches in that order, the one it ends in is passed over; what they leave is
filled from the other blocks, and of the block that the target ends in by documents in
a permuted order as far as they fit. Where all other blocks are too few, long documents
that were passed over fill the rest as far as they fit.

The block copies that each source contributes are exact quotas. A binary tree over
the output shards splits them: at every node the left half's share of each source is
drawn from a multivariate hypergeometric distribution, seeded by the node, so every
leaf can follow its own path without the others. The quotas of the leaves cut each
source's permuted block copies into disjoint runs, one per shard, and a shard's
documents are ordered by hash.

Edge cases: a null or empty text has size 0 and isn't taken. A null source is a source
(the last one). Sources of size 0 have target 0. Rows equal in ``doc_id``, source and
text share their fate. A null ``doc_id`` is one like any other. Other columns are kept,
whatever their names. An empty table gives no rows. Ties in hash order go by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from barsmith.llm.common import documents, written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 20
FILL_ORDERS = 32
SEED = 20_011
LONG_CANDIDATES = 10_000  # long documents looked at to fill a rest: first in order, and as many of the shortest
BROADCAST_SOURCES = 100_000  # rows of (source, numbers): a few MB


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Words each source is to give, of as many in all as there are."""
    names = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    free, left = list(names), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > MAX_REPEATS * sizes[s]]
        for s in over or free:
            out[s] = float(MAX_REPEATS * sizes[s]) if over else share * weight[s]
        if not over:
            break
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in set(over)]
    return out


def shard_quotas(copies: list[int], shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(first rank, number) per source of the block copies that ``shard`` gets.

    Follows the splitting tree from the root to the shard's leaf. Shard sizes in
    blocks differ by at most one.
    """
    total = sum(copies)
    upto = lambda j: j * total // shards  # noqa: E731  blocks of the shards before j
    have, first = np.array(copies, np.int64), np.zeros(len(copies), np.int64)
    lo, hi = 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(have, upto(mid) - upto(lo), method="marginals")
        if shard < mid:
            have, hi = left, mid
        else:
            have, first, lo = have - left, first + left, mid
    return first, have


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Documents of a block that together come near its gap.

    They are taken in a permuted order as far as they fit, then one more if that
    ends nearer; of ``FILL_ORDERS`` orders the one that ends nearest is used.
    """
    pdf = pdf.sort_values("key")
    keys, words, gap = pdf["key"].tolist(), pdf["words"].tolist(), float(pdf["gap"].iloc[0])
    best, best_rest = [], gap
    for i in range(FILL_ORDERS):
        chosen, left, over = [], gap, None
        for at in np.random.default_rng([SEED, i]).permutation(len(keys)).tolist():
            if words[at] <= left:
                chosen.append(keys[at])
                left -= words[at]
            elif over is None or words[at] < words[over]:
                over = at
        if over is not None and words[over] - left < left:
            chosen.append(keys[over])
            left = words[over] - left
        if left < best_rest:
            best, best_rest = chosen, left
        if left < 1:
            break
    return pd.DataFrame({"key": np.array(best, np.int64)})


def sized(docs: DataFrame) -> DataFrame:
    """(key, doc_id, source, size) of each row; the key names rows of equal id, source and text."""
    return docs.select(
        F.xxhash64("doc_id", "source", "text").alias("key"), "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
    )


def draw(rows: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """``rows`` (a written ``sized`` table) with ``source_size``, ``target`` and ``shards``,
    the output shard of each copy that the mix takes of the row (repeats included)."""
    spark = rows.sparkSession
    # rows of one key are one unit; at most a row for each block_words words is long
    per_key = rows.filter("size > 0").groupBy("key", "source").agg(F.sum("size").alias("words"))
    long_units = written(per_key.filter(F.col("words") > block_words), "long")
    in_long = {r["source"]: r["n"] for r in long_units.groupBy("source").agg(F.sum("words").alias("n")).collect()}
    # one row per source, as many as the mix has weights
    total = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    goal = targets(total)
    names = sorted(total, key=lambda s: (s is None, "" if s is None else s))
    plan = []
    for i, s in enumerate(names):
        passes = int(goal[s] // total[s]) if total[s] else 0
        plan.append((i, s, total[s], goal[s], max(1, ceil((total[s] - in_long.get(s, 0)) / block_words)), passes, goal[s] - passes * total[s]))
    plan_df = spark.createDataFrame(plan, "source_no int, source string, source_size long, target double, n_blocks long, passes int, remainder double")
    if len(plan) <= BROADCAST_SOURCES:
        plan_df = F.broadcast(plan_df)
    placed = (
        rows.withColumnRenamed("source", "own").join(plan_df, F.col("own").eqNullSafe(F.col("source")))
        .join(long_units.select("key", F.lit(True).alias("long")), "key", "left").withColumn("long", F.coalesce("long", F.lit(False)))
        # long documents have negative blocks
        .withColumn("block", F.when(F.col("long"), F.col("key").bitwiseOR(F.lit(-(1 << 63)))).otherwise(F.pmod(F.xxhash64("key", F.lit(seed)), "n_blocks")))
    )
    order = lambda *c: F.xxhash64(*c, F.lit(seed + 1))
    by_order = Window.partitionBy("source_no").orderBy("order", "block")
    by_source = Window.partitionBy("source_no")
    # a word count per block, a block for each block_words words: small beside the rows
    blocks = (
        placed.groupBy("source_no", "block", "long", "passes", "remainder").agg(F.sum("size").alias("words"))
        .withColumn("order", order("source_no", "block"))
        .withColumn("reached", F.col("long") & (F.sum("words").over(by_order) <= F.col("remainder")))
        .withColumn("short", F.when(F.col("long"), 0).otherwise(F.col("words")))
        .withColumn("need", F.col("remainder") - F.sum(F.when(F.col("reached"), F.col("words")).otherwise(0)).over(by_source))
        .withColumn("before", F.sum("short").over(by_order) - F.col("short"))
        .withColumn("left", F.col("need") - F.sum("short").over(by_source))
        .withColumn("whole", F.when(F.col("long"), F.col("reached")).otherwise(F.col("before") + F.col("words") <= F.col("need")))
        .withColumn("gap", F.when(~F.col("long") & ~F.col("whole") & (F.col("before") < F.col("need")), F.col("need") - F.col("before")))
        .select("source_no", "block", "long", "words", "order", "left", "passes", "whole", "gap")
    )
    blocks = written(blocks, "blocks")
    # a source's other blocks may be too few for what its long documents leave
    passed = blocks.filter(F.col("long") & ~F.col("whole") & (F.col("left") > 0) & (F.col("words") < 2 * F.col("left")))
    for name, by in (("nth", ("order", "block")), ("nth_short", ("words", "block"))):
        passed = passed.withColumn(name, F.row_number().over(Window.partitionBy("source_no").orderBy(*by)))
    passed = passed.filter((F.col("nth") <= LONG_CANDIDATES) | (F.col("nth_short") <= LONG_CANDIDATES))
    more = (
        passed.select("source_no", F.col("block").alias("key"), "words", F.col("left").alias("gap"))
        .groupBy("source_no").applyInPandas(_fill, "key long").select(F.col("key").alias("block"), F.lit(True).alias("more"))
    )
    blocks = blocks.join(more, "block", "left").withColumn("whole", F.col("whole") | F.coalesce("more", F.lit(False)))
    blocks = written(blocks.select("source_no", "block", "passes", "whole", "gap"), "filled-blocks")
    ends = blocks.filter("gap is not null").select("source_no", "block", "gap")
    units = placed.filter("size > 0").groupBy("key", "source_no", "block").agg(F.sum("size").alias("words"))
    chosen = (
        units.join(ends, ["source_no", "block"])
        .groupBy("source_no", "block").applyInPandas(_fill, "key long")
    )
    chosen = written(chosen, "chosen").withColumn("chosen", F.lit(True))

    copies = blocks.withColumn("n", F.col("passes") + F.col("whole").cast("int") + F.col("gap").isNotNull().cast("int"))
    copies = copies.filter("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
    copies = copies.withColumn("partial", F.col("gap").isNotNull() & (F.col("copy") == F.col("n")))
    ranked = copies.withColumn("rank", F.row_number().over(Window.partitionBy("source_no").orderBy(order("source_no", "block", "copy"), "block", "copy")) - 1)
    quota = {r["source_no"]: r["count"] for r in copies.groupBy("source_no").count().collect()}
    quotas = [quota.get(i, 0) for i in range(len(plan))]
    words = sum(goal.values())
    shards = max(1, min(ceil(words / shard_words), sum(quotas)))

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"].tolist():
                first, number = shard_quotas(quotas, shards, shard, seed)
                some = np.flatnonzero(number)
                yield pd.DataFrame({"source_no": some.astype(np.int32), "first": first[some], "number": number[some], "shard": np.int32(shard)})

    runs = spark.range(shards).mapInPandas(leaves, "source_no int, first long, number long, shard int")
    runs = runs.select("source_no", "shard", F.explode(F.expr("sequence(first, first + number - 1)")).alias("rank"))
    by_block = (
        ranked.join(runs, ["source_no", "rank"])
        .groupBy("source_no", "block")
        .agg(F.sort_array(F.collect_list(F.when(~F.col("partial"), F.col("shard")))).alias("in_full"), F.max(F.when(F.col("partial"), F.col("shard"))).alias("in_part"))
    )
    by_block = written(by_block, "by-block")
    out = placed.join(by_block, ["source_no", "block"], "left").join(chosen, "key", "left")
    none = F.array().cast("array<int>")
    shards_of = F.concat(F.coalesce("in_full", none), F.when(F.col("chosen") & F.col("in_part").isNotNull(), F.array("in_part")).otherwise(none))
    return out.select(
        "key", "doc_id", F.col("own").alias("source"), "size", "source_size", "target",
        F.when(F.col("size") > 0, shards_of).otherwise(none).alias("shards"),
    )


def mix_rows(docs: DataFrame) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as the mix takes it, all its columns,
    grouped by output shard and shuffled inside."""
    name = "_mix"
    while any(c.startswith(name) for c in docs.columns):
        name += "_"
    drawn = draw(written(sized(docs), "sized")).filter(F.size("shards") > 0).select(F.col("key").alias(f"{name}_key"), F.col("shards").alias(f"{name}_shards"))
    keyed = docs.withColumn(f"{name}_key", F.xxhash64("doc_id", "source", "text"))
    # rows of one key share their draw
    out = keyed.join(drawn.dropDuplicates([f"{name}_key"]), f"{name}_key")
    out = out.select(*docs.columns, f"{name}_key", F.posexplode(f"{name}_shards").alias(f"{name}_copy", f"{name}_shard"))
    out = out.withColumn(f"{name}_order", F.xxhash64(f"{name}_key", f"{name}_copy", F.lit(SEED + 2)))
    # a shard is bounded by SHARD_WORDS, whole shards go to a task
    out = out.repartition(f"{name}_shard").sortWithinPartitions(f"{name}_shard", f"{name}_order")
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = draw(written(sized(documents(spark, sf_dir)), "sized"))
    copies = F.size("shards")
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"), copies.cast("long").alias("copies"), "shards")
