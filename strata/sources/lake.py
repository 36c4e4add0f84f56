"""Named tables of the session catalog, written by Spark's own writers.

A ``Lake`` is one database: its tables are read with ``spark.table`` and written
with ``saveAsTable`` (schema replaced), ``INSERT INTO`` (rows added) and
``INSERT OVERWRITE`` (all rows, or, with dynamic partition overwrite, only the
partitions that the written rows fall in).  Declared tables are created with
``CREATE TABLE IF NOT EXISTS`` and keep their column types and comments whatever
is written.

Spark can't overwrite a table that the written frame reads, so a result that
depends on the table is written elsewhere first: small ones are checkpointed
(``settled``), those of the size of a batch or a table are staged as Parquet
(``staged``).  The merges on top are
idempotent and the high-water mark is written last, so a run that dies halfway is
simply run again.

The database needs a location that every executor reaches: the warehouse, or a
folder below the shared checkpoint folder (``scratch_lake``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column as Expression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.schema import Column, literal_frame
from strata.session import checkpoint_dir, scratch_path

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Partition:
    """A partition column and the SQL expression that gives its values (never null)."""

    column: str
    type: str
    expression: str

    def declared(self) -> Column:
        return Column(self.column, self.type, f"partition: {self.expression}")

    def of(self) -> Expression:
        return F.expr(self.expression).cast(self.type)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Lake:
    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        where = f" LOCATION {_quoted(location)}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        """The table as it stands; ``KeyError`` if there is none."""
        if not self.exists(table):
            raise KeyError(f"no table {table!r} in database {self.database!r}")
        return self.spark.table(self.name(table))

    def read_or_empty(self, table: str, columns: list[Column]) -> DataFrame:
        return self.read(table) if self.exists(table) else literal_frame(self.spark, [], columns)

    # --- writes ---------------------------------------------------------------

    def overwrite(self, table: str, df: DataFrame, partition_by: Iterable[str] = ()) -> None:
        """Replace the table, schema included (SNK-1, SNK-2)."""
        df.write.format("parquet").mode("overwrite").partitionBy(*partition_by).saveAsTable(self.name(table))

    def create(self, table: str, columns: list[Column], partition: Partition | None = None, also_by: Iterable[str] = ()) -> bool:
        """``CREATE TABLE IF NOT EXISTS`` with declared types and comments (SNK-4);
        False if the table was there.  ``also_by`` names columns to partition by
        before ``partition``."""
        there = self.exists(table)
        declared = [*columns, *([partition.declared()] if partition else [])]
        fields = ", ".join(f"`{c.name}` {c.type}" + (f" COMMENT {_quoted(c.comment)}" if c.comment else "") for c in declared)
        by = ", ".join(f"`{c}`" for c in [*also_by, *([partition.column] if partition else [])])
        parts = f" PARTITIONED BY ({by})" if by else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({fields}) USING parquet{parts}")
        return not there

    def _insert(self, table: str, df: DataFrame, overwrite: bool) -> None:
        # INSERT goes by position; the table's own order has partition columns last.
        df.select(*self.spark.table(self.name(table)).columns).write.insertInto(self.name(table), overwrite=overwrite)

    def append(self, table: str, rows: DataFrame) -> None:
        """Add ``rows``; only they are written (SNK-3)."""
        self._insert(table, rows, overwrite=False)

    def replace(self, table: str, rows: DataFrame) -> None:
        """Replace all rows; the declared columns and their comments stay."""
        self._insert(table, rows, overwrite=True)

    def replace_partitions(self, table: str, rows: DataFrame) -> None:
        """Replace only the partitions that ``rows`` fall in (dynamic partition
        overwrite); partitions without a row in ``rows`` keep their files."""
        before = self.spark.conf.get(OVERWRITE_MODE)
        self.spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            self._insert(table, rows, overwrite=True)
        finally:
            self.spark.conf.set(OVERWRITE_MODE, before)

    def drop_partitions(self, table: str, column: str, values: Iterable) -> None:
        for value in values:  # one statement per emptied partition
            own = _quoted(value) if isinstance(value, str) else str(value)
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (`{column}` = {own})")

    # --- catalog --------------------------------------------------------------

    def columns(self, tables: list[str]) -> DataFrame:
        """table_name, position (from 1), column_name, data_type, comment of the
        stored columns, as the catalog has them (one row per column)."""
        rows = [
            (table, i, c.name, c.dataType, c.description)
            for table in tables
            for i, c in enumerate(self.spark.catalog.listColumns(self.name(table)), 1)
        ]
        return literal_frame(
            self.spark,
            rows,
            [Column("table_name", "string"), Column("position", "int"), Column("column_name", "string"), Column("data_type", "string"), Column("comment", "string")],
        )

    def property(self, table: str, key: str) -> str | None:
        """A property kept with the table; None if it is not set."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return {r["key"]: r["value"] for r in rows}.get(key)

    def set_property(self, table: str, key: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ({_quoted(key)} = {_quoted(value)})")


def scratch_lake(spark: SparkSession, label: str) -> Lake:
    """A new database below the shared checkpoint folder."""
    own = f"strata_{label}_{uuid.uuid4().hex[:12]}"
    return Lake(spark, own, scratch_path(spark, "lake", own))


# Writes that the driver has under way at a time.
WRITES_AT_ONCE = 4


def together(writes: Iterable[Callable[[], object]]) -> list:
    """The results of independent writes, begun in this order, some at a time: cores
    that a write with few tasks leaves idle go to the next one.  The first error is
    raised."""
    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        begun = [pool.submit(write) for write in writes]
        return [write.result() for write in begun]


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder: it may then be
    written over a table that it was read from."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def staged(df: DataFrame, by: str | None = None) -> Iterator[DataFrame]:
    """``df`` computed once into Parquet files below the shared checkpoint folder,
    for the length of a ``with`` block; the files go at its end.

    Later passes read only the columns they use, and the files take a fraction of a
    checkpoint, which holds whole rows.  ``by`` names a column whose values are
    brought together first, in parts that Spark joins and splits by their bytes: a
    write partitioned by it then makes few files, and a large value is no single task.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged", uuid.uuid4().hex)
    try:
        (df.hint("rebalance", by) if by else df).write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
