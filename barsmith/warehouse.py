"""Marts as external tables of the session's catalog.

A refresh writes what it changes as Parquet into folders of its own (``stage``) and
points the tables there when all of it is written (``publish``): a table without
partitions by ``ALTER TABLE .. SET LOCATION``, one with a row per ticker and day month by
month, as each of its partitions has a location of its own. Nothing a table points at is
ever written or deleted, so a refresh that fails before it publishes changes nothing,
queries that run meanwhile keep reading the files they began with, and months that don't
change are neither read nor written.

A switch is one catalog statement; there is none over several tables. One refresh at a
time is expected. Folders that no table points at any more are left to the storage's own
retention rules.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.paths import list_names

MONTH = "trade_month"  # partition column of tables with a row per ticker and day


def month_of(col: str = "trade_date") -> Column:
    return F.date_format(col, "yyyy-MM")


def months_in(df: DataFrame) -> set[str]:
    """The distinct months of ``df``'s trade dates: one value per calendar month."""
    return {r[0] for r in df.select(month_of()).distinct().collect()}


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def properties_clause(properties: Mapping[str, str]) -> str:
    return "TBLPROPERTIES (" + ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in sorted(properties.items())) + ")"


@dataclass(frozen=True)
class Staged:
    """Written rows of a table that no reader sees yet."""

    table: str
    path: str
    schema: T.StructType  # without the month column
    months: tuple[str, ...] | None  # None: a table without partitions

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path).select(*self.schema.fieldNames())


class Warehouse:
    """The tables of one catalog database."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark, self.database = spark, database
        at = f" LOCATION {quoted(location)}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
        self.location = spark.catalog.getDatabase(database).locationUri.rstrip("/")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def partitioned(self, table: str) -> bool:
        return self.exists(table) and any(c.isPartition for c in self.spark.catalog.listColumns(self.name(table)))

    def properties(self, table: str) -> dict[str, str]:
        if not self.exists(table):
            return {}
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def months(self, table: str) -> list[str]:
        """The months of a partitioned table, ascending."""
        if not self.exists(table):
            return []
        return sorted(r[0].partition("=")[2] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect())

    def read(self, table: str, schema: T.StructType, months: Iterable[str] | None = None) -> DataFrame:
        """A table's current rows (only those of ``months``: other partitions aren't listed)."""
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.table(self.name(table))
        if months is not None:
            rows = rows.where(F.col(MONTH).isin(sorted(months)))
        return rows.select(*schema.fieldNames())

    def stage(self, table: str, df: DataFrame, order: Sequence[Column] = (), by_month: bool = False) -> Staged:
        """Write rows of ``table`` into a fresh folder; not visible before ``publish``.

        ``order`` is the row order on disk: rows are dealt out by ranges of it (inside
        each month), so files hold disjoint ranges and a large month has several files.
        """
        path = f"{self.location}/{table}/{uuid.uuid4().hex[:16]}"
        schema = T.StructType(df.schema.fields)
        keys = [F.col(MONTH), *order] if by_month else list(order)
        out = df.withColumn(MONTH, month_of()) if by_month else df
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else out
        writer = out.write.partitionBy(MONTH) if by_month else out.write
        writer.parquet(path)
        prefix = f"{MONTH}="
        months = [n[len(prefix):] for n in list_names(self.spark, path) if n.startswith(prefix)] if by_month else None
        return Staged(table, path, schema, None if months is None else tuple(months))

    def bucketed(self, table: str, df: DataFrame, by: Sequence[str], buckets: int, sort: Sequence[str]) -> DataFrame:
        """``df`` as a new table in ``buckets`` buckets of ``by``, one sorted file each.

        Joins and windows that cluster by ``by`` read it without an exchange. An earlier
        table of that name is dropped (its files stay).
        """
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        path = f"{self.location}/{table}/{uuid.uuid4().hex[:16]}"
        rows = df.repartition(buckets, *by)  # as buckets are dealt, so a task writes one bucket
        rows.write.format("parquet").bucketBy(buckets, *by).sortBy(*sort).option("path", path).saveAsTable(self.name(table))
        return self.spark.table(self.name(table))

    def publish(self, staged: Staged, properties: Mapping[str, str] = {}, whole: bool = True) -> None:
        """Make staged rows current: the whole table, or (``whole=False``) just their months."""
        name, sql = self.name(staged.table), self.spark.sql
        at = f"LOCATION {quoted(staged.path)}"
        if not self.exists(staged.table):
            fields = [*staged.schema.fields, *([T.StructField(MONTH, T.StringType())] if staged.months is not None else [])]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            by = f" PARTITIONED BY (`{MONTH}`)" if staged.months is not None else ""
            sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} {at}")
        elif staged.months is None:
            sql(f"ALTER TABLE {name} SET {at}")
        if staged.months is not None:
            before = set(self.months(staged.table))
            part = lambda m: f"PARTITION (`{MONTH}` = {quoted(m)})"
            folder = lambda m: "LOCATION " + quoted(f"{staged.path}/{MONTH}={m}")
            for m in staged.months:
                if m in before:
                    sql(f"ALTER TABLE {name} {part(m)} SET {folder(m)}")
            if added := [m for m in staged.months if m not in before]:
                sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"{part(m)} {folder(m)}" for m in added))
            if whole and (gone := sorted(before.difference(staged.months))):
                sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(part(m) for m in gone))  # external: files stay
        self.set_properties(staged.table, properties)

    def set_properties(self, table: str, properties: Mapping[str, str]) -> None:
        if properties:
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET {properties_clause(properties)}")

    def view(self, view: str, query: str, properties: Mapping[str, str] = {}) -> None:
        """A persistent view with its metadata."""
        clause = f" {properties_clause(properties)}" if properties else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)}{clause} AS {query}")
