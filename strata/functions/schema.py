"""Declared output schemas: column types and comments (SNK-6, SNK-4)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    comment: str = ""


def conform(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Select the declared columns in order, cast to the declared types and
    attach each comment as column metadata (what a materialized view with a
    column list declares)."""
    out = df.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in columns])
    for c in columns:
        if c.comment:
            out = out.withMetadata(c.name, {"comment": c.comment})
    return out


def _literal(value, column: Column):
    if isinstance(value, datetime) and column.type == "timestamp_ntz":
        # From text: no time zone (process or session) can shift it.
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(value).cast(column.type)


def literal_frame(spark, rows: list[tuple], columns: list[Column]) -> DataFrame:
    """A small DataFrame of literal rows whose size Catalyst knows.

    ``createDataFrame(list)`` is backed by an RDD of unknown size, which every
    size check must treat as huge; literals expanded from a one-row range
    are sized exactly and fold into a local relation.
    """
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(c.type).alias(c.name) for c in columns])
    structs = [F.struct(*[_literal(v, c).alias(c.name) for v, c in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))

