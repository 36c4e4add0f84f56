"""Bronze ingest: raw retail CSV files -> bronze tables (JOB-B, SNK-1).

The customers file holds quoted fields with embedded newlines and doubled
quotes, so it is read in multi-line mode; the other three are plain header
CSV.  Each ingest is a full overwrite of the bronze table.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sources.raw_files import read_csv
from strata.sources.lake import Lake, together

# (bronze table, file name or pattern, multi-line?) of the raw retail layer.
RETAIL_FILES = (
    ("bronze_customers", "customers.csv", True),
    ("bronze_orders", "orders_part-*.csv", False),
    ("bronze_products", "products.csv", False),
    ("bronze_transactions", "transactions.csv", False),
)


def read_retail(
    spark: SparkSession, folder: str, schemas: dict[str, StructType | str] | None = None
) -> dict[str, DataFrame]:
    """The four raw retail files as DataFrames keyed by bronze table name."""
    schemas = schemas or {}
    folder = folder.rstrip("/")
    return {
        table: read_csv(spark, f"{folder}/{file}", schemas.get(table), multiline=multi)
        for table, file, multi in RETAIL_FILES
    }


def ingest_retail(
    spark: SparkSession, folder: str, lake: Lake, schemas: dict[str, StructType | str] | None = None
) -> list[str]:
    """Overwrite the four bronze tables from the raw files; returns their names."""
    frames = read_retail(spark, folder, schemas)
    together([partial(lake.overwrite, name, df) for name, df in frames.items()])
    return list(frames)
