"""Keyed upsert of one frame into another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key set of ``df``; a key that occurs twice fails the job when the plan runs.

    Counting combines map-side and leaves the data partitioned by key, as the join that follows needs it: the check
    adds no shuffle. Rows with a null key part never match and are left out.
    """
    counted = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    message = F.concat(F.lit("duplicate merge key: "), F.to_json(F.struct(*keys)))
    return counted.filter(F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(True)).select(
        *keys
    )


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a partner in ``source``, whose keys must be unique.

    Target rows with a null key part have no partner; they go past the join, so that they do not meet in one task.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    kept = target.filter(complete).join(unique_keys(source, keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(target.filter(~complete))


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-all / insert-all: target rows without a partner in ``source``, plus every source row.

    ``source`` is read twice: stage it where that costs, or where it may change between two reads.
    """
    return unmatched(target, source, keys).unionByName(source.select(*target.columns))
