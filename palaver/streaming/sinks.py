"""Stream sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from palaver.operators.dedup import deduplicate
from palaver.sources.changes import append_changes
from palaver.sources.tables import CODEC, find_table, in_same_directories, staged, upsert_partitions

TRIGGER = "1 minute"


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Micro-batches at an interval, or, without one, all that is there now."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), every: str | None = TRIGGER
) -> StreamingQuery:
    """Append rows to a table that only this stream writes; with the checkpoint, each row is written once.

    The file sink keeps a log in the folder, and readers then see the stream's files alone: a table that batch jobs also
    write needs ``merge_updates``.
    """
    writer = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .option("compression", CODEC).partitionBy(*partition_by)
    )
    return _triggered(writer, every).start(path)


def merge_updates(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    mode: str = "update",
    every: str | None = TRIGGER,
    version: str | None = None,
    tie_break: Sequence[str] = (),
) -> StreamingQuery:
    """Merge the rows of each micro-batch into a partitioned table by ``keys``, as the batch upsert does.

    Batch and stream can share such a table, and a retried micro-batch changes nothing. A batch that may hold several
    versions of a key needs ``version``, the column that orders them; then a version older than the table's is dropped.
    Rows with a null key part are versions of nothing: they are added, and those of a retried batch that are already
    there, in every column, are not added again.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = staged(batch, "batch")
        no_key = " OR ".join(f"`{k}` IS NULL" for k in keys)
        keyed, loose = rows.dropna(subset=list(keys)), rows.filter(no_key)
        target = find_table(spark, path, batch.schema)
        if target is not None and not loose.isEmpty():
            loose = loose.exceptAll(in_same_directories(target, loose, partition_by).filter(no_key))
        if version:
            if target is not None:
                near = in_same_directories(target, rows, partition_by)
                keyed = keyed.unionByName(near.join(keyed.select(*keys).distinct(), list(keys), "left_semi"))
            keyed = deduplicate(keyed, keys, version, tie_break=tie_break)
        upsert_partitions(spark, keyed.unionByName(loose), path, keys, partition_by)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _triggered(writer, every).start()


def add_changes(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = TRIGGER, source: str = "stream"
) -> StreamingQuery:
    """Append each micro-batch to the change folder of the table at ``path``; a batch costs what it holds.

    Readers use ``read_current``; a batch job folds the changes in. ``source`` must be of this checkpoint alone.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        append_changes(batch, path, epoch, source)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _triggered(writer, every).start()


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait for queries that end by themselves (no interval); a failure is raised."""
    for query in queries:
        query.awaitTermination()


def await_any(spark: SparkSession) -> None:
    """Block while interval queries run; returns or raises when one of the session's queries ends."""
    spark.streams.awaitAnyTermination()
