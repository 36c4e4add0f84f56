"""Helpers shared by the operators: lineage cuts and skew-proof numbering."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

# Numbering splits every group into this many buckets, so that a group holding
# a third of all rows is still numbered by many tasks.
NUMBER_BUCKETS = 1024


def cut(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    Executors may be lost afterwards: later reads take the files.  Spark's
    cleaner removes them with the frame (``cleanCheckpoints``).  The number of
    files follows the data: Spark joins and splits shuffle partitions by their
    bytes.  Narrow rows that come from a scan may be shuffled by the columns
    ``by`` first, so that they do not make one small file per scan task.
    """
    checkpoint_dir(df.sparkSession)
    return (df.repartition(*by) if by else df).checkpoint()


def cut_per_core(df: DataFrame) -> DataFrame:
    """As ``cut``, in as many files as the cluster runs tasks at once: for the many
    checkpoints of neighbour lists, which the tool was last run with."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    return df.coalesce(spark.sparkContext.defaultParallelism).checkpoint()


def release(df: DataFrame) -> None:
    """Let Spark's cleaner drop the shuffles and checkpoints of past rounds.

    It removes them when the driver collects its garbage, which an iterative job
    with little driver work may not do for long.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


# Bytes of an Arrow batch of texts.  A task holds a few copies of a batch on either
# side, outside the heap, and an idle Python worker does not give its own back: with
# Spark's 64 MB (10,000 rows) they stand beside the heap of the next stage.
BATCH_BYTES = 2 << 20


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose rows go to Python in Arrow batches of ``BATCH_BYTES`` and the
    row that fills them (a longer text goes alone).

    It is a setting of the session, read when a frame runs.  Rows and their order
    stay, so steps that hold for any batch give the same results.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and bind it for ``body``.

    A name that is used inside a lambda would otherwise be computed again for
    each element when the optimizer merges projections.
    """
    return F.transform(F.array(value), body).getItem(0)


def key_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on columns of the same names.

    Columns: all of ``left``, then those of ``right`` beside ``on`` (their names
    must differ from ``left``'s).  Both sides may stem from one frame.
    """
    renamed = {c: f"{c} of right" for c in on}
    right = right.select(*[F.col(c).alias(renamed.get(c, c)) for c in right.columns])
    pairs = [F.col(f"`{c}`").eqNullSafe(F.col(f"`{r}`")) for c, r in renamed.items()]
    match = pairs[0]
    for p in pairs[1:]:
        match = match & p
    return left.join(right, match, how).drop(*renamed.values())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names built from ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def numbered(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    buckets: int = NUMBER_BUCKETS,
    deal: Column | None = None,
) -> DataFrame:
    """Add ``name``: a gapless number from 0 within each ``group``.

    Rows of a group are dealt to ``buckets`` buckets by a hash of ``order`` (or
    by ``deal``, a whole number);
    each (group, bucket) is numbered on its own and shifted by the rows of the
    buckets before it.  ``df`` is read twice (counts, rows); rows equal in
    ``order`` are numbered in any order.  Null group or order values are values
    like any other.
    """
    bucket, before = fresh(df, "bucket", "before")
    rows = df.withColumn(bucket, F.pmod(F.xxhash64(*order) if deal is None else deal, F.lit(buckets)).cast("int"))
    keys = [*group, bucket]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(before))
    ahead = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum(before).over(ahead), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    rows = rows.withColumn(name, place.cast("long"))
    return key_join(rows, offsets, keys).withColumn(name, F.col(name) + F.col(before)).select(*df.columns, name)


def distinct_texts(rows: DataFrame, group: str) -> dict:
    """About how many distinct texts each group of ``rows`` (group, text) has."""
    found = rows.groupBy(group).agg(F.approx_count_distinct(_drawn(F.col("text"))).alias("n")).collect()
    return {r[group]: r["n"] for r in found}  # one row per group


def _drawn(text: Column) -> Column:
    return F.xxhash64(F.lit("sample"), text)


def smallest_hashes(rows: DataFrame, group: str, sizes: dict, wanted: dict) -> DataFrame:
    """group, text, hash_1 of the ``wanted`` distinct texts of each group whose
    hashes are smallest: a sample that depends neither on how often a text stands
    nor on how rows are dealt.

    A limit well above the share wanted of ``sizes`` goes first, so that few rows
    move; copies become one row before they do.
    """

    def by_group(values: dict) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col(group)]

    share = {g: min(1.0, 1.5 * (wanted[g] + 50) / n) if n else 1.0 for g, n in sizes.items()}
    limit = {g: int((2 * s - 1) * (2**63 - 1)) if s < 1 else 2**63 - 1 for g, s in share.items()}
    hashed = rows.select(group, "text", _drawn(F.col("text")).alias("hash_1"), F.xxhash64("text").alias("hash_2"))
    near = hashed.filter(F.col("hash_1") <= by_group(limit))
    near = near.groupBy(group, "hash_1", "hash_2").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy(group).orderBy("hash_1", "hash_2"))
    return near.withColumn("place", place).filter(F.col("place") <= by_group(wanted)).select(group, "text", "hash_1")


SALTS = 16


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Null-safe equi-join that splits hot keys of ``left``.

    Rows of ``left`` are dealt to ``SALTS`` parts by a hash of ``by``; ``right``
    is repeated once per part, so it should be the small side (one row per
    key).  Columns: all of ``left``, then those of ``right`` beside ``on``.
    """
    part = "part"
    while part in [c.lower() for c in (*left.columns, *right.columns)]:
        part = "_" + part
    a = left.withColumn(part, F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    b = right.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return key_join(a, b, [*on, part], how).drop(part)


# Rows of one key that a task takes in ``dealt_join``, and the keys that are split
# at most: those with the most rows.  A key beyond them holds less than a
# millionth of all rows.
ROWS_PER_PART = 2_000
SPLIT_KEYS = 1 << 20


def dealt_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Null-safe equi-join that splits each hot key of ``left`` by its count.

    A key with n rows in ``left`` is dealt to ceil(n / ``ROWS_PER_PART``) parts by a
    hash of ``by``; its rows of ``right`` (one per key, say) are repeated once per
    part, those of all other keys stand once.  The split keys travel as a broadcast
    of at most ``SPLIT_KEYS`` rows of two numbers.  ``left`` is read twice.
    Columns: all of ``left``, then those of ``right`` beside ``on``.
    """
    part, = fresh(left.select(*left.columns, *[F.lit(0).alias(c) for c in right.columns if c not in left.columns]), "part")
    rows = left.groupBy(F.xxhash64(*on).alias("_hot")).agg(F.count(F.lit(1)).alias("_parts")).filter(F.col("_parts") > ROWS_PER_PART)
    hot = rows.orderBy(F.desc("_parts"), "_hot").limit(SPLIT_KEYS)
    hot = F.broadcast(hot.select("_hot", F.ceil(F.col("_parts") / ROWS_PER_PART).cast("long").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))

    match = F.xxhash64(*on) == F.col("_hot")
    a = left.join(hot, match, "left").select(*left.columns, F.pmod(F.xxhash64(*by), parts).alias(part))
    # Part 0 is the row itself; only the rows of split keys are repeated.
    more = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_parts") - 1))
    b = right.select(*right.columns, F.lit(0).cast("long").alias(part))
    b = b.unionByName(right.join(hot, match).select(*right.columns, more.alias(part)))
    return key_join(a, b, [*on, part], how).drop(part)
