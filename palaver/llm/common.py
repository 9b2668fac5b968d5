"""Small helpers of the operators: learning split, written intermediates, bounded driver-side choices."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.sources.scratch import scratch_dir

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id") -> Column:
    """True for the fifth of the keys that no model learns from; false for a null key, which is not learned from either."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def may_learn(key: str = "doc_id") -> Column:
    return F.col(key).isNotNull() & ~held_out(key)


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, after naming the folder of this package in the search path of the session's Python workers.

    Where the package is installed, or shipped with the job, this changes nothing; it spares both where driver and workers
    see the same folder.
    """
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])
    return df


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared folder and read back: computed once, and whole when an executor is lost."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
