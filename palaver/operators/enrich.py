"""Equi joins that add columns from, or restrict by, another table. Broadcasting is left to Spark's size checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Left equi join under different key names; the dimension's key column is dropped.

    A hot key on the left (one sender with most messages) is split by adaptive skew-join handling, which may divide
    the left side of a left join.
    """
    right = dimension.withColumnRenamed(dimension_key, "_lookup_key")
    return df.join(right, F.col(key) == F.col("_lookup_key"), "left").drop("_lookup_key")


def lookup_spread(
    df: DataFrame, key: str, row_id: str, dimension: DataFrame, dimension_key: str, copies: int = 8
) -> DataFrame:
    """``lookup`` on a text key that is often null or shared by many rows, against a deduplicated dimension.

    Adaptive skew handling needs shuffled inputs on both sides; deduplication leaves a window there. So rows are spread by
    hand: each takes one of ``copies`` slots by its id, and every dimension row is offered in all slots. Null keys match
    nothing and become a marker made of the row id; a zero character leads it, so it cannot equal a real key.
    """
    slots = F.sequence(F.lit(0), F.lit(copies - 1))
    right = dimension.filter(F.col(dimension_key).isNotNull()).withColumnRenamed(dimension_key, "_lookup_key")
    right = right.withColumn("_lookup_slot", F.explode(slots))
    left = df.withColumns({
        "_spread_key": F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(row_id))),
        "_slot": F.pmod(F.xxhash64(row_id), F.lit(copies)).cast("int"),
    })
    matches = (F.col("_spread_key") == F.col("_lookup_key")) & (F.col("_slot") == F.col("_lookup_slot"))
    return left.join(right, matches, "left").drop("_spread_key", "_slot", "_lookup_key", "_lookup_slot")


def restrict_to(df: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """Inner join against a filtered dimension whose keys are unique."""
    right = members.select(F.col(member_key).alias("_member_key"))
    return df.join(right, F.col(key) == F.col("_member_key"), "inner").drop("_member_key")
