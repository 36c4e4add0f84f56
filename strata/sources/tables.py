"""Access to the driver's parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class DriverTables:
    """Lazy handles on ``<root>/<name>.parquet``.

    Reading is lazy: a job that touches two columns of ``lineitem`` makes
    Catalyst prune the scan to those two columns and push its filters into
    the parquet reader.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)
