"""How five document filters interact: what each removes, alone and behind the others.

1. One transducer pass over every whole text (``transducer.py``) gives words, distinct
   words, capitals, code points and symbols; SHA-256 in the same task names the text.
2. The first ``doc_id`` of each repeated text comes from a partial aggregation; groups of
   more than a thousandth of all rows are broadcast (fewer than a thousand), the others joined.
3. A document is then a set of failed filters, five bits. Documents are counted by
   (part, doc_id, set) before labels are joined, so no ``doc_id`` holds more than 32 rows
   a part there, and by (part, set) after it: at most 32 rows a part.
4. From these, each part's 120 orders of five steps follow.

Filters: A fewer than 50 words; B 100 * distinct words < 65 * words; C 100 * ``[A-Z]`` > 5 *
code points; D any of ``[#$%&*|]``; E equal to the text of any smaller ``doc_id``.

Edge cases: a null text counts as empty, a null ``source`` is the part of the empty string.
A null ``doc_id`` is neither smaller nor larger than another: such rows pass E and have no
labels. Rows equal in ``doc_id`` and text don't fail E through each other. A ``doc_id`` with
several labels is good (toxic) if any says so. Null labels say nothing. Other columns are
ignored. An empty table gives no parts and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import transducer
from barsmith.llm.common import documents, join_groups, text_bytes, written

# --- fixed values: the filters and their thresholds ------------------------------------
LETTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5

BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
_MEASURED = pa.schema([("part", pa.string()), ("doc_id", pa.int64()), ("digest", pa.binary()), *((c, pa.int64()) for c in transducer.COUNTS)])
_MEASURED_DDL = "part string, doc_id long, digest binary, " + ", ".join(f"{c} long" for c in transducer.COUNTS)
_COUNTED = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column(2).to_pylist()]
        counts = transducer.text_counts(texts)
        digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
        columns = [batch.column(0).cast(pa.string()), batch.column(1).cast(pa.int64()), digests, *(pa.array(counts[:, k]) for k in range(counts.shape[1]))]
        yield pa.RecordBatch.from_arrays(columns, schema=_MEASURED)


def measured(docs: DataFrame) -> DataFrame:
    """(part, doc_id, digest, counts) of each document, one pass over its text."""
    rows = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return rows.mapInArrow(_measured, _MEASURED_DDL)


def failed_filters(docs: DataFrame) -> DataFrame:
    """``measured`` with ``failed``: the failed filters as bits (``BIT``)."""
    rows = written(measured(docs), "audit-measured")
    first = written(
        rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")).filter("copies > 1"), "audit-first")
    rows = join_groups(rows, first, ["digest"], "copies", rows.count())
    c = F.col
    fails = {
        "A": c("n_words") < MIN_WORDS,
        "B": 100 * c("n_distinct") < MIN_DISTINCT_PERCENT * c("n_words"),
        "C": 100 * c("n_capitals") > MAX_CAPITALS_PERCENT * c("n_points"),
        "D": c("n_symbols") > 0,
        "E": F.coalesce(c("doc_id") > c("first_id"), F.lit(False)),
    }
    bits = F.lit(0)
    for letter, failed in fails.items():
        bits = bits + F.when(failed, BIT[letter]).otherwise(0)
    return rows.select(*[x for x in rows.columns if x not in ("copies", "first_id")], bits.alias("failed"))


def _steps(counts: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part, from its documents by set of failed filters."""
    table = np.zeros((3, 1 << len(LETTERS)), np.int64)
    table[:, counts["failed"].to_numpy()] = counts[["docs", "good", "toxic"]].to_numpy().T
    failed = np.arange(table.shape[1])
    rows = []
    for order in permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = BIT[letter]
            fails, reached = (failed & bit) != 0, (failed & before) == 0
            removed, good, toxic = table[:, fails & reached].sum(axis=1).tolist()
            rows.append((
                counts["part"].iloc[0], "".join(order), step, int(table[0, reached & ~fails].sum()), removed, int(table[0, fails & ~reached].sum()),
                int(table[0, bit]), good, toxic, letter,
            ))
            before |= bit
    out = pd.DataFrame(rows, columns=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "letter"])
    out["shapley"] = out.groupby("letter")["removed"].transform("sum")
    return out.drop(columns="letter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every part, order and step (``_COUNTED``)."""
    by_doc = failed_filters(docs).groupBy("part", "doc_id", "failed").agg(F.count(F.lit(1)).alias("n"))
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    with_id = by_doc.filter("doc_id is not null").join(said, "doc_id", "left")
    without = by_doc.filter("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    n = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    sets = with_id.unionByName(without).groupBy("part", "failed").agg(F.sum("n").alias("docs"), n("good").alias("good"), n("toxic").alias("toxic"))
    return sets.groupBy("part").applyInPandas(_steps, _COUNTED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents
), split AS (
  SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY body) AS first_id FROM texts
), marks AS (
  SELECT s.part,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN s.doc_id > first_id THEN 'E' ELSE '' END AS failed,
    coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM split s LEFT JOIN labels l ON l.doc_id = s.doc_id
), sets AS (
  SELECT part, failed, count(*) AS docs, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM marks GROUP BY part, failed
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.letter NOT IN (b.letter, c.letter, d.letter, e.letter) AND b.letter NOT IN (c.letter, d.letter, e.letter)
    AND c.letter NOT IN (d.letter, e.letter) AND d.letter <> e.letter
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), judged AS (
  SELECT part, filter_order, step, letter, docs, good, toxic, failed,
    contains(failed, letter) AS fails, translate(failed, before, '') = failed AS reached
  FROM sets, steps
), counted AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(docs) FILTER (WHERE reached AND NOT fails), 0) AS kept, coalesce(sum(docs) FILTER (WHERE reached AND fails), 0) AS removed,
    coalesce(sum(docs) FILTER (WHERE fails AND NOT reached), 0) AS redundant, coalesce(sum(docs) FILTER (WHERE failed = letter), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE reached AND fails), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE reached AND fails), 0) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
