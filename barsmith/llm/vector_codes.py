"""Vector codes: each vector's parts as indexes into trained codebooks.

Vectors become integers (floor(256 * x)) and are cut into ``PARTS`` equal consecutive
parts. A part position's codebook starts from the ``ENTRIES`` smallest vec_ids; each round
assigns every part of all vectors to its nearest entry and moves the entries to their
parts' mean. Codebooks are ``PARTS`` x ``ENTRIES`` small vectors whatever the table's size:
tasks add up their parts per entry, the sums are added per (part, entry), and 1,024 entries
go back to the driver and, with the next round's closure, to the tasks.

The nearest entry is found by equal-average search. With n components, a part of component
sum s and an entry of sum t are at least (s - t)^2 / n apart. Entries are sorted by sum; from
the place of s the search goes outward on both sides and leaves a side once that bound
strictly exceeds the best distance, so equal distances are still met and the lower index
wins. All parts of a batch step together, those done drop out. All of it is exact: 64-bit
integers for parts whose distances they hold, Python integers for the others.

Edge cases: rows whose vector is null or holds null or non-finite components are dropped.
Shorter vectors count as padded with zeros to the longest one, that to a multiple of
``PARTS``; so an empty vector is all zeros. Fewer kept rows than ``ENTRIES`` give smaller
codebooks. Null vec_ids come last among the first entries, equal ones are ordered by vector;
repeated rows are coded each. Null labels are one label. An error beyond 64 bits is null, as
is then its label's. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import join_groups, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LONGEST = (1 << 63) - 1


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    x = F.col("embedding")
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return vectors.filter(x.isNotNull()).filter(F.forall(x, ok)).select("vec_id", "label", x.cast("array<double>").alias("vector"))


def _whole(x: float) -> int:
    return int(x) * SCALE if abs(x) >= 2.0**52 else math.floor(SCALE * x)


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) of each vector, padded with zeros to ``width``; exact."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(vectors.offsets.to_numpy())
    plain = not len(flat) or np.abs(flat).max() < 2.0**52
    out = np.zeros((len(sizes), width), np.int64 if plain else object)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, columns] = np.floor(SCALE * flat).astype(np.int64) if plain else [_whole(v) for v in flat.tolist()]
    return out


def _fits(largest: int, width: int) -> bool:
    """Whether 64 bits hold what the search computes of components up to ``largest``."""
    return (2 * largest * max(width, 1)) ** 2 * max(width, 1) < 1 << 62


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each part's nearest entry, ties to the lower index."""
    width = parts.shape[1]
    reach = max((abs(int(x)) for x in entries.ravel()), default=0)
    if _fits(max(reach, int(np.abs(parts).max(initial=0))), width):
        return _search(parts.astype(np.int64), entries.astype(np.int64))
    index, best = np.zeros(len(parts), np.int64), np.zeros(len(parts), object)
    large = np.array([not _fits(max(reach, *map(abs, row)), width) for row in parts.tolist()], bool)
    for rows, kind in ((large, object), (~large, np.int64)):
        if rows.any():
            index[rows], best[rows] = _search(parts[rows].astype(kind), entries.astype(kind))
    return index, best


def _search(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, width = parts.shape
    sums = entries.sum(axis=1) if width else np.zeros(len(entries), entries.dtype)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    mine = parts.sum(axis=1) if width else np.zeros(n, parts.dtype)
    right = np.searchsorted(sums, mine)
    best, index = np.zeros(n, parts.dtype), np.full(n, -1)

    def visit(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Look at the entry in place ``at`` of each row; which rows the bound lets go on."""
        gap = mine[rows] - sums[at]
        go = (index[rows] < 0) | (gap * gap <= best[rows] * width)
        rows, found = rows[go], order[at[go]]
        apart = parts[rows] - entries[found]
        distance = (apart * apart).sum(axis=1) if width else np.zeros(len(rows), parts.dtype)
        better = (index[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (found < index[rows]))
        best[rows[better]], index[rows[better]] = distance[better], found[better]
        return rows

    up, down, step = np.arange(n), np.arange(n), 0
    while len(up) or len(down):
        up = up[right[up] + step < len(order)]
        up = visit(up, right[up] + step)
        down = down[right[down] - 1 - step >= 0]
        down = visit(down, right[down] - 1 - step)
        step += 1
    return index, best


Codebooks = list[list[list[int]]]  # by part, entry, component


def _coded(vectors: pa.Array, books: Codebooks, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(its parts, indexes, distances) of each part position."""
    values = integers(vectors, width)
    size = width // PARTS
    for p, book in enumerate(books):
        part = values[:, p * size : (p + 1) * size]
        entries = np.array(book, object).reshape(len(book), size)
        yield part, *nearest(part, entries)


def _sums(books: Codebooks, width: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width // PARTS
        totals = [np.zeros((len(b), size), object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, (part, index, _) in enumerate(_coded(batch.column(0), books, width)):
                found, at = np.unique(index, return_inverse=True)
                safe = part.dtype != object and int(np.abs(part).max(initial=0)) * len(part) < 1 << 62
                some = np.zeros((len(found), size), np.int64 if safe else object)
                np.add.at(some, at, part)
                totals[p][found] += some
                counts[p] += np.bincount(index, minlength=len(counts[p]))
        rows = [(p, e, int(n), [str(x) for x in totals[p][e]]) for p in range(len(books)) for e, n in enumerate(counts[p]) if n]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()))
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "entry", "n", "totals"])

    return add


def _mean(found: pd.DataFrame) -> pd.DataFrame:
    """The mean of one entry's parts, from the sums of all tasks (one row a task)."""
    n = int(found["n"].sum())
    mean = [str(sum(map(int, column)) // n) for column in zip(*found["totals"])]
    return pd.DataFrame({"part": found["part"].iloc[:1], "entry": found["entry"].iloc[:1], "mean": [mean]})


def first_codebooks(kept: DataFrame, width: int, entries: int = ENTRIES) -> Codebooks:
    """Parts of the kept vectors with the smallest vec_ids."""
    rows = kept.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    values = integers(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), width)
    size = width // PARTS
    return [[[int(x) for x in row[p * size : (p + 1) * size]] for row in values] for p in range(PARTS)]


def trained_codebooks(kept: DataFrame, width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    books = first_codebooks(kept, width, entries)
    for _ in range(rounds):
        sums = kept.select("vector").mapInArrow(_sums(books, width), "part int, entry int, n long, totals array<string>")
        # PARTS x ENTRIES rows
        for r in sums.groupBy("part", "entry").applyInPandas(_mean, "part int, entry int, mean array<string>").collect():
            books[r["part"]][r["entry"]] = [int(x) for x in r["mean"]]
    return books


def checksum(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def _codes(books: Codebooks, width: int, schema: pa.Schema):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            indexes = np.zeros((batch.num_rows, len(books)), np.uint8)
            error = np.zeros(batch.num_rows, object)
            for p, (_, index, distance) in enumerate(_coded(batch.column(2), books, width)):
                indexes[:, p] = index
                error += distance
            text = [row.tobytes().hex() for row in indexes]
            fits = [None if e > LONGEST else int(e) for e in error]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(fits, pa.int64())], schema=schema)

    return code


def vector_codes(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each kept vector; at most 256 ``entries``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = kept_vectors(vectors)
    longest, total = kept.agg(F.max(F.size("vector")), F.count(F.lit(1))).first()
    width = -(-(longest or 0) // PARTS) * PARTS
    books = trained_codebooks(kept, width, entries, rounds)
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    rows = written(kept.mapInArrow(_codes(books, width, to_arrow_schema(schema)), schema), "vector-codes")
    known = F.count("error") == F.count(F.lit(1))
    labels = rows.groupBy("label").agg(
        F.when(known, F.sum(F.col("error").cast("decimal(38,0)"))).alias("sum"), F.count(F.lit(1)).alias("members"))
    labels = written(labels.select("label", "members", F.expr("try_cast(sum as bigint)").alias("label_error")), "vector-labels")
    out = join_groups(rows, labels, ["label"], "members", total)
    return out.select("vec_id", "code", "error", "label_error", F.lit(checksum(books)).alias("codebooks_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(rounds: int = ROUNDS) -> str:
    """The definition in SQL: all distances, no search."""
    steps = [
        """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""",
        """parts AS (
  SELECT vec_id, label, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, (SELECT unnest(range(16)) AS p)
)""",
        "seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64)",
        "book0 AS (SELECT p, e, x AS c FROM parts JOIN seed USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS (
  SELECT vec_id, label, p, x, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) AS best
  FROM parts JOIN book{r} USING (p) GROUP BY vec_id, label, p, x
)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (
  SELECT p, best % 64 AS e, i, sum(x[i]) AS s, count(*) AS n FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY ALL
), means{r} AS (
  SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM sums{r} GROUP BY p, e
), book{r + 1} AS (
  SELECT b.p, b.e, coalesce(m.m, b.c) AS c FROM book{r} b LEFT JOIN means{r} m ON b.p = m.p AND b.e = m.e
)""")
    steps.append(f"""coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(best % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id, label
), whole AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)""")
    return "WITH " + ", ".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, whole"""


SQL = _sql()
