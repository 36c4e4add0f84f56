"""Previous / next row within a key, without a per-key window.

``lag``/``lead`` over ``Window.partitionBy(key)`` sort each key's rows in one
task, so a key holding a third of the rows becomes a third of the job in a
single task.  Here the rows are range-partitioned on ``(keys..., order...)``,
which spreads a hot key over many partitions (see ``strata.operators.rank``).
The neighbour of a row is ``lag``/``lead`` inside its partition; the rows at a
partition's edge take it from a broadcast table with one row per partition.
It counts only when its key equals the row's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.rank import inside, staged

PREV, NEXT = "prev", "next"


def with_neighbor(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    cols: list[str],
    side: str = NEXT,
    prefix: str | None = None,
) -> DataFrame:
    """Add ``<prefix><col>`` for each of ``cols``: the value in the previous
    (``side="prev"``) or next row of the same key in ``order``, NULL at the
    key's edge.  Also adds ``<prefix>exists`` (a neighbour of the same key
    exists).  ``order`` must make rows of one key totally ordered.
    """
    if side not in (PREV, NEXT):
        raise ValueError(side)
    prefix = prefix if prefix is not None else f"{side}_"
    step, edge_of = (F.lag, F.max_by) if side == PREV else (F.lead, F.min_by)
    rows = staged(df, [*[F.col(k) for k in keys], *order])
    row = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    # The last (or first) row of each partition, handed to the next one.
    edges = rows.groupBy("_pid").agg(edge_of(row, "_mid").alias("_edge"))
    edges = edges.select("_pid", step("_edge").over(Window.orderBy("_pid")).alias("_edge"))
    near = rows.withColumn("_near", step(row).over(inside())).join(F.broadcast(edges), "_pid")
    near = near.withColumn("_near", F.coalesce("_near", "_edge"))
    same = F.col("_near").isNotNull()
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_near.k{i}"))
    return near.select(
        *df.columns,
        *[F.when(same, F.col(f"_near.v{i}")).alias(f"{prefix}{c}") for i, c in enumerate(cols)],
        same.alias(f"{prefix}exists"),
    )
