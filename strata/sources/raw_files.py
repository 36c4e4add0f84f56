"""Raw CSV sources and their audits (SRC-1..3, SRC-5, SRC-6).

Production reads should pass an explicit schema: ``inferSchema`` costs an
extra pass over the files (a Spark job) and its guess can change between
batches.  Plain CSV is splittable, so big files are read in parallel
(``spark.sql.files.maxPartitionBytes`` per task); ``multiLine`` CSV is not
splittable (a record may cross any byte offset), so each such file is read by
one task: keep multi-line sources to many moderate files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Header CSV; a file or a folder of files (every file is read).

    ``multiline`` accepts quoted fields with embedded newlines and quotes
    doubled inside quoted fields (a quote written twice).  Without a schema the
    column types are inferred.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    return reader.csv(path)


def read_text_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header CSV with every column kept as a string (``SELECT *`` of raw
    files, as the bike pipeline's bronze view does)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def file_audit(df: DataFrame) -> DataFrame:
    """Per input file: path, size in bytes and row count (SRC-5).

    Uses the hidden ``_metadata`` column of file sources, so it is a normal
    distributed aggregate; nothing is listed on the driver.
    """
    return df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def file_audits(tables: dict[str, DataFrame]) -> DataFrame:
    """``file_audit`` of several tables with their names, stacked."""
    out = None
    for name, df in tables.items():
        own = file_audit(df).select(F.lit(name).alias("table_name"), "*")
        out = own if out is None else out.unionByName(own)
    return out


def profile(name: str, df: DataFrame) -> DataFrame:
    """One row: table_name, row_count, column_count, schema (SRC-6).  The first
    rows are ``strata.plans.medallion.first_rows``."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )


def profiles(tables: dict[str, DataFrame]) -> DataFrame:
    """``profile`` for several tables, stacked (one Spark job)."""
    out = None
    for name, df in tables.items():
        p = profile(name, df)
        out = p if out is None else out.unionByName(p)
    return out
