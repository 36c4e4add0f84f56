"""Global ranking, running and moving sums without one task for all rows.

``row_number().over(Window.orderBy(...))`` has no partition key, so Spark
plans it as a single-partition window: every row lands in one task.  Here the
same numbers are computed in parallel, by one plan at every size:

1. range-partition on the sort keys (Spark samples the keys for bounds, so a
   value held by many rows is split by the tiebreak columns) and sort inside
   each partition; no partition count is given, so AQE joins neighbouring
   small partitions and their number follows the rows, not the setting;
2. tag each row with its partition id and ``monotonically_increasing_id``
   (partition id << 33 plus the row's position in that sorted partition);
3. checkpoint that result to the shared checkpoint folder, so that the passes
   below read the same materialised order;
4. count (or total) the rows per partition, prefix-sum these over the
   partitions and broadcast that table back.

The broadcast tables have one row per range partition (``width`` rows for
moving sums), a bound set by the partition count, not by the rows.

``top_k`` is the bounded case: the first ``k`` rows by the same order, which
Spark plans as ``TakeOrderedAndProject`` (each task keeps k rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_dir


def _order_exprs(order: list[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def staged(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Range-partitioned, sorted, tagged with partition id (``_pid``) and
    position (``_mid``), and checkpointed (steps 1-3 above)."""
    checkpoint_dir(df.sparkSession)
    exprs = _order_exprs(order)
    return (
        df.repartitionByRange(*exprs)
        .sortWithinPartitions(*exprs)
        .withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
        .checkpoint(eager=True)
    )


def inside() -> Window:
    """The rows of one range partition, in order."""
    return Window.partitionBy("_pid").orderBy("_mid")


def partition_offsets(rows: DataFrame, *totals: Column) -> DataFrame:
    """Per partition: the sums of ``totals`` over all earlier partitions
    (``_off0``, ``_off1``...).  One row per partition."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy("_pid").agg(*[t.alias(f"_t{i}") for i, t in enumerate(totals)])
    return per.select(
        "_pid", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_off{i}") for i in range(len(totals))]
    )


def _position() -> Column:
    """Position of a row inside its partition, from 0."""
    return F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)


def global_row_number(df: DataFrame, order: list[Column | str], name: str = "rank") -> DataFrame:
    """Add ``name`` (bigint, 1-based) = row number of each row in ``order``.

    ``order`` must be a total order (end it with a unique key) for the
    numbering to be deterministic.
    """
    rows = staged(df, order)
    offsets = partition_offsets(rows, F.count(F.lit(1)))
    return (
        rows.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off0") + _position() + 1).cast("long"))
        .drop("_pid", "_mid", "_off0")
    )


def _running(rows: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    """``rows`` with their running sums and ``_i``, their position from 1."""
    offsets = partition_offsets(rows, F.count(F.lit(1)), *[F.sum(c) for c in cols])
    upto = inside().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(F.broadcast(offsets), "_pid").withColumns(
        {f"{prefix}{c}": F.sum(c).over(upto) + F.col(f"_off{i + 1}") for i, c in enumerate(cols)}
    )
    out = out.withColumn("_i", F.col("_off0") + _position() + 1)
    return out.drop(*[f"_off{i}" for i in range(len(cols) + 1)])


def running_sums(df: DataFrame, order: list[Column | str], cols: list[str], prefix: str = "cum_") -> DataFrame:
    """Add ``<prefix><col>`` = sum of ``col`` over all rows up to and
    including this one in ``order`` (a total order): a running sum inside each
    range partition plus the totals of all earlier partitions."""
    return _running(staged(df, order), cols, prefix).drop("_pid", "_mid", "_i")


def moving_sums(
    df: DataFrame, order: list[Column | str], cols: list[str], width: int, prefix: str = "moving_"
) -> DataFrame:
    """Add ``<prefix><col>`` = sum of ``col`` over this row and the
    ``width - 1`` rows before it in ``order``.

    ``cum[i] - cum[i - width]``: the earlier running sum is ``lag`` inside the
    range partition; the first ``width`` rows of a partition take it from the
    last ``width`` rows of the partitions before (broadcast, ``width`` rows
    per partition).
    """
    rows = _running(staged(df, order), cols, "_c_")
    edge = Window.partitionBy("_pid").orderBy(F.desc("_mid"))
    tails = (
        rows.withColumn("_end", F.row_number().over(edge))
        .filter(F.col("_end") <= width)
        .select((F.col("_i") + width).alias("_i"), *[F.col(f"_c_{c}").alias(f"_e_{c}") for c in cols])
    )
    lagged = rows.withColumns({f"_l_{c}": F.lag(f"_c_{c}", width).over(inside()) for c in cols})
    out = lagged.join(F.broadcast(tails), "_i", "left")
    zero = {c: F.lit(0).cast(df.schema[c].dataType) for c in cols}
    out = out.withColumns(
        {f"{prefix}{c}": F.col(f"_c_{c}") - F.coalesce(f"_l_{c}", f"_e_{c}", zero[c]) for c in cols}
    )
    return out.select(*df.columns, *[f"{prefix}{c}" for c in cols])


def top_k(df: DataFrame, order: list[Column | str], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows by ``order`` with their 1-based position.

    ``orderBy(...).limit(k)`` becomes ``TakeOrderedAndProject``: every task
    keeps its own k best rows and only those reach the final merge.  The
    numbering window then runs over at most k rows.
    """
    exprs = _order_exprs(order)
    best = df.orderBy(*exprs).limit(k)
    return best.withColumn(name, F.row_number().over(Window.orderBy(*exprs)).cast("long"))
