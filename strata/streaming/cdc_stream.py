"""Streaming CDC apply (STM-1): change files -> merged table, exactly once.

A file-source stream picks up new change-feed files; each micro-batch is merged
into the stored table inside ``foreachBatch``, touched partitions only.  The
stream's checkpoint (its log of processed files) replaces the high-water-mark
table of the batch jobs.

Failure model: the number of the last merged epoch is kept with the table, as a
table property per stream.  If the job dies after the merge but before the stream
records the epoch as done, the epoch comes again and is skipped; if it dies
between the merge and the property, it is merged again, which changes nothing.
With ``trigger(availableNow=True)`` the stream processes what has arrived and
stops, which suits scheduled runs.

Files of one drop may reach the merge in any order: the table keeps tombstones,
and the result does not depend on the order (see ``apply_changes``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.functions.schema import Column
from strata.operators.merge import apply_changes, merge_partitions
from strata.session import checkpoint_dir
from strata.sources.lake import Lake, Partition, staged


def epoch_property(stream: str) -> str:
    return f"strata.epoch.{stream}"


def merge_epoch(
    lake: Lake,
    table: str,
    changes: DataFrame,
    epoch_id: int,
    keys: list[str],
    partition: Partition,
    stream: str,
) -> bool:
    """Merge one micro-batch unless its epoch was merged before; False if it was."""
    last = lake.property(table, epoch_property(stream))
    if last is not None and epoch_id <= int(last):
        return False
    with staged(changes) as batch:
        merge_partitions(lake, table, batch, keys, lambda old, ch: apply_changes(old, ch, keys), partition)
    lake.set_property(table, epoch_property(stream), str(epoch_id))
    return True


def start_cdc_stream(
    spark: SparkSession,
    feed_dir: str,
    feed_schema: StructType,
    lake: Lake,
    table: str,
    columns: list[Column],
    keys: list[str],
    checkpoint_location: str,
    partition: Partition,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files_per_trigger: int | None = None,
    stream: str = "cdc",
) -> StreamingQuery:
    """Start the stream; call ``awaitTermination()`` for an available-now run.

    ``transform`` turns raw feed rows into changes (checks, derived columns);
    it must keep ``keys``, ``updated_at`` and ``cdc_operation``.  ``stream``
    names the stream in the table's property: one name per checkpoint location.
    """
    checkpoint_dir(spark)
    lake.create(table, columns, partition)
    reader = spark.readStream.schema(feed_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        merge_epoch(lake, table, transform(batch), epoch_id, keys, partition, stream)

    return (
        reader.parquet(feed_dir)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
