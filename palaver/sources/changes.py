"""Change folders: micro-batches append their rows beside a table, readers take the latest version of a key.

``<table>.changes/_source=<name>/_batch=<number>/`` holds the rows of one micro-batch and nothing else, so that a batch
writes bytes in proportion to itself, whatever the table holds. Only batches whose write was committed are seen. A batch job
folds them into the table's directories and removes them. It alone replaces directories of the table; streams only add
batches, so both may run at once.

The row of a key with the highest ``version``, then ``tie_break``, is the current one; of equal rows that of the later
batch, and any batch's before the table's. Without ``version`` the batch number decides. Rows with a null key part are
versions of nothing and all stay. A repeated batch replaces itself, or does nothing where it was folded before. A fold that
stopped half-way is finished by the next one from its staged rows. While a fold replaces directories, a reader may see rows
without a key twice; rows with a key are always right.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palaver.operators.dedup import deduplicate
from palaver.operators.merge import merge, unmatched
from palaver.schemas import Contract, ddl
from palaver.sources.files import Files
from palaver.sources.scratch import scratch_dir
from palaver.sources.tables import (
    CODEC, find_table, in_same_directories, overwrite_partitions, read_table, write_table,
)

DONE, FOLDED, INTENT = "_SUCCESS", "_FOLDED", "_fold"


class Keyed(NamedTuple):
    """What decides which row of a table is current."""

    contract: Contract
    keys: Sequence[str]
    partition_by: Sequence[str]
    version: str | None = None
    tie_break: Sequence[str] = ()


def changes_path(path: str) -> str:
    return f"{path.rstrip('/')}.changes"


def append_changes(batch: DataFrame, path: str, number: int, source: str = "stream") -> None:
    """Write one micro-batch. ``source`` names the checkpoint: numbers count within it."""
    target = f"{changes_path(path)}/_source={source}/_batch={number}"
    if not Files(batch.sparkSession, target).exists(f"{target}/{FOLDED}"):
        batch.write.mode("overwrite").parquet(target, compression=CODEC)


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Directories of the batches that wait to be folded."""
    files = Files(spark, path)
    pattern = f"{changes_path(path)}/_source=*/_batch=*"
    folded = {f.rsplit("/", 1)[0] for f in files.matching(f"{pattern}/{FOLDED}")}
    return [d for f in files.matching(f"{pattern}/{DONE}") if (d := f.rsplit("/", 1)[0]) not in folded]


def read_changes(spark: SparkSession, path: str, contract: Contract, batches: Sequence[str] | None = None) -> DataFrame | None:
    """All rows of waiting batches with ``_source`` and ``_batch``, or None when there are none."""
    batches = committed_batches(spark, path) if batches is None else batches
    if not batches:
        return None
    schema = f"{ddl(contract)}, _source string, _batch long"
    return spark.read.schema(schema).option("basePath", changes_path(path)).parquet(*batches)


def _no_key(keys: Sequence[str]) -> str:
    return " OR ".join(f"`{k}` IS NULL" for k in keys)


def _current(near: DataFrame | None, changes: DataFrame, spec: Keyed) -> DataFrame:
    """The current rows of the changed keys, and the rows without a key. ``near`` may hold earlier versions."""
    columns = list(spec.contract)
    keyed = changes.dropna(subset=list(spec.keys))
    versions = keyed.select(*columns, "_batch")
    if near is not None:
        earlier = near.join(keyed.select(*spec.keys).distinct(), list(spec.keys), "left_semi").select(*columns)
        versions = versions.unionByName(earlier.withColumn("_batch", F.lit(-1).cast("long")))
    order = [spec.version, *spec.tie_break, "_batch"] if spec.version else ["_batch"]
    newest = deduplicate(versions, spec.keys, order[0], tie_break=order[1:])
    return newest.select(*columns).unionByName(changes.filter(_no_key(spec.keys)).select(*columns))


def read_current(spark: SparkSession, path: str, spec: Keyed) -> DataFrame:
    """The table with its waiting changes. Of the table, only directories that changes touch are looked at for versions."""
    table, changes = find_table(spark, path, spec.contract), read_changes(spark, path, spec.contract)
    if changes is None:
        return read_table(spark, path, spec.contract) if table is None else table
    if table is None:
        return _current(None, changes, spec)
    return merge(table, _current(in_same_directories(table, changes, spec.partition_by), changes, spec), spec.keys)


def fold_changes(spark: SparkSession, path: str, spec: Keyed) -> int:
    """Merge the batches that wait now into the table's directories and remove them; their number is returned."""
    _finish(spark, path)
    batches = committed_batches(spark, path)
    changes = read_changes(spark, path, spec.contract, batches)
    if changes is None:
        return 0
    table = find_table(spark, path, spec.contract)
    touched = None if table is None else in_same_directories(table, changes, spec.partition_by)
    # Current rows and those of the table that stay are staged side by side, so that no row is staged twice.
    folder = scratch_dir(spark, "fold")
    write_table(_current(touched, changes, spec), f"{folder}/current")
    if touched is not None:
        current = read_table(spark, f"{folder}/current", spec.contract)
        write_table(unmatched(touched, current, spec.keys), f"{folder}/kept")
    intent = spark.createDataFrame([(f"{folder}/*", batches, list(spec.partition_by))], _INTENT)
    write_table(intent.coalesce(1), f"{changes_path(path)}/{INTENT}", mode="overwrite")
    _finish(spark, path)
    return len(batches)


_INTENT = "staged string, batches array<string>, partition_by array<string>"


def _finish(spark: SparkSession, path: str) -> None:
    """Carry out a fold whose merged rows are staged. Each step can be repeated."""
    files, intent = Files(spark, path), f"{changes_path(path)}/{INTENT}"
    if not files.exists(f"{intent}/{DONE}"):
        return
    todo = read_table(spark, intent, StructType.fromDDL(_INTENT)).first()
    merged = spark.read.parquet(todo.staged)
    overwrite_partitions(merged, path, todo.partition_by)
    newest: dict[str, int] = {}
    for batch in todo.batches:
        source, number = batch.rsplit("/_batch=", 1)
        newest[source] = max(newest.get(source, -1), int(number))
    for batch in todo.batches:
        source, number = batch.rsplit("/_batch=", 1)
        # A stream repeats no batch but its last one: that keeps a mark.
        if int(number) == newest[source]:
            files.touch(f"{batch}/{FOLDED}")
            for old in files.matching(f"{batch}/*.parquet"):
                files.remove(old)
        else:
            files.remove(batch)
    files.remove(intent)
