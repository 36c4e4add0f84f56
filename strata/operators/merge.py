"""Merges as DataFrame expressions: upsert, delete, CDC apply, SCD type 2.

Open-source Spark has no ``MERGE INTO`` for plain parquet tables, so each
merge is a pure function ``(target, changes) -> new target``;
``merge_partitions`` writes the result over the partitions of a stored table that
a batch touches.

The cost of a merge follows the batch: ``strata.operators.keyset.split`` divides
the target, where it is read, into rows that may hold a key of the batch and all
others.  Only the first meet the batch in a shuffle; the others pass through a
filter into the result.  Every merge leaves a row whose key is not in the batch as
it is, so the few such rows among the first do no harm.  ``changes`` is used
twice (keys, merge): pass a checkpointed frame, or one that is cheap to compute.

Every merge here is idempotent (applying the same batch twice gives the same
table as applying it once), so replaying a batch after a crash between
writing the table and storing the high-water mark is safe.

``keep_first`` reduces keys to one row with a partial ``WindowGroupLimit``
before its shuffle, so a key repeated many times in a batch does not pile up
in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import keep_first
from strata.operators.keyset import split
from strata.operators.sequence import NEXT, PREV, with_neighbor
from strata.sources.lake import Lake, Partition, staged

INSERT, UPDATE, DELETE = "I", "U", "D"


def latest_per_key(
    changes: DataFrame, keys: list[str], ts: str = "updated_at", first: list[Column] | None = None
) -> DataFrame:
    """The newest change per key; equal times are broken by ``first`` and
    then by every other column, so the choice never depends on input order."""
    lead = [F.col(ts).desc_nulls_last(), *(first or [])]
    rest = [c for c in changes.columns if c not in keys and c != ts]
    return keep_first(changes, keys, [*lead, *rest])


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], ts: str = "updated_at") -> DataFrame:
    """SCD type 1 / ``WHEN MATCHED UPDATE ... WHEN NOT MATCHED INSERT``: per
    key the newest of the target row and the changes stays, so a change that
    arrives late does not undo a newer one.  ``target`` has the ``ts`` column
    and at most one row per key."""
    touched, rest = split(target, changes, keys)
    return rest.unionByName(latest_per_key(touched.unionByName(changes.select(*target.columns)), keys, ts))


def delete_keys(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """``WHEN MATCHED DELETE``: drop target rows whose key is in ``doomed``, by an
    anti-join of those that may hold one.  A null key matches nothing."""
    touched, rest = split(target, doomed, keys)
    return rest.unionByName(touched.join(doomed.select(*keys).distinct(), keys, "left_anti"))


DELETED = "is_deleted"


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    ts: str = "updated_at",
    op: str = "cdc_operation",
) -> DataFrame:
    """Apply a change feed of inserts, updates and deletes.

    Per key the newest of the target row and the changes stays (a delete then
    a re-insert ends inserted, an update then a delete ends deleted); a delete
    at the same time as another operation wins.

    A delete leaves its row as a tombstone (column ``is_deleted``) when the
    target has that column, so that an older insert arriving later does not
    bring the key back; ``live_rows`` hides them.  A target without the column
    keeps live rows only, which is right when no change arrives late.
    """
    marked = changes.withColumn(DELETED, F.col(op) == DELETE)
    old = target if DELETED in target.columns else target.withColumn(DELETED, F.lit(False))
    touched, rest = split(old, changes, keys)
    rows = latest_per_key(touched.unionByName(marked.select(*old.columns)), keys, ts, first=[F.col(DELETED).desc()])
    rows = rest.unionByName(rows)
    return rows if DELETED in target.columns else live_rows(rows)


def live_rows(table: DataFrame) -> DataFrame:
    """The table without its tombstones."""
    return table.filter(~F.col(DELETED)).drop(DELETED)


def scd2_merge(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    tracked: list[str],
    ts: str = "updated_at",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    current: str = "is_current",
) -> DataFrame:
    """Versioned dimension (SCD type 2) merge.

    * A change opens a new version only when one of ``tracked`` differs from
      the version before it (compared NULL-safely); other columns changing
      alone do nothing, so re-running a batch is a no-op.
    * Several changes of one key in a batch are chained in time order: each
      version is valid until the next one starts; the last is current.
    * The current target version is closed (``is_current`` false,
      ``valid_to`` = start of its successor).
    * A change not newer than the key's current version is late and ignored.

    Plan: closed versions and current versions of other keys pass through.  The
    late-change test is a join with the current versions that a key of the
    batch may have (one per key); "previous version" and "next version" come
    from ``with_neighbor``, which range-partitions these and the changes, so a key
    that changes very often is spread over many tasks instead of one window
    partition.
    """
    payload = [c for c in target.columns if c not in (valid_from, valid_to, current)]
    rest = [F.col(c).asc_nulls_first() for c in payload if c not in keys]
    live, others = split(target, changes, keys, within=F.col(current))

    live_from = live.select(*keys, F.col(valid_from).alias("_live_from"))
    fresh = (
        changes.select(*payload, F.col(ts).alias("_t"), F.lit(1).alias("_src"))
        .join(live_from, keys, "left")
        .filter(F.col("_live_from").isNull() | (F.col("_t") > F.col("_live_from")))
        .drop("_live_from")
    )
    rows = live.select(*payload, F.col(valid_from).alias("_t"), F.lit(0).alias("_src")).unionByName(fresh)

    rows = with_neighbor(rows, keys, ["_t", "_src", *rest], tracked, PREV, prefix="_p_")
    same_as_prev = F.lit(True)
    for c in tracked:
        same_as_prev = same_as_prev & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    opens = (F.col("_src") == 0) | ~F.col("_p_exists") | ~same_as_prev
    versions = rows.filter(opens).select(*payload, "_t", "_src")

    versions = with_neighbor(versions, keys, ["_t", "_src", *rest], ["_t"], NEXT, prefix="_n")
    closed_or_new = versions.select(
        *payload,
        F.col("_t").alias(valid_from),
        F.col("_n_t").alias(valid_to),
        F.col("_n_t").isNull().alias(current),
    )
    # Live rows that gained no successor come out identical to their input.
    return others.unionByName(closed_or_new.select(*target.columns))


def touched_parts(df: DataFrame, partition: Partition) -> list:
    """The distinct partition values of ``df`` (one per partition reaches the driver)."""
    return sorted(r[0] for r in df.select(partition.of()).distinct().collect())


def merge_partitions(
    lake: Lake,
    table: str,
    changes: DataFrame,
    keys: list[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    partition: Partition,
    moves: bool = True,
) -> list:
    """Merge ``changes`` into the stored ``table``, reading and rewriting only the
    partitions involved; returns their values.

    They are the partitions of the changed rows and (when a row's partition can
    change, e.g. by a corrected date) those that hold one of the changed keys,
    found by a pass over the key and partition columns of the table.
    ``merge(old, changes)`` sees the rows of these partitions without the partition
    column; its result is staged with the rows of a partition together, then written
    by dynamic partition overwrite, so the files of a partition follow its bytes, not
    the tasks of the merge.  A partition that the merge has emptied is dropped.

    ``changes`` is used several times: pass a staged or checkpointed frame.
    """
    whole = lake.read(table)
    touched = set(touched_parts(changes, partition))
    if moves:
        holders, _ = split(whole, changes, keys)
        touched |= {r[0] for r in holders.select(partition.column).distinct().collect()}
    if not touched:
        return []
    own = [c for c in whole.columns if c != partition.column]
    old = whole.filter(F.col(partition.column).isin(sorted(touched))).select(*own)
    with staged(merge(old, changes).withColumn(partition.column, partition.of()), by=partition.column) as rows:
        lake.replace_partitions(table, rows)
        left = {r[0] for r in rows.select(partition.column).distinct().collect()}
    lake.drop_partitions(table, partition.column, sorted(touched - left))
    return sorted(touched)
