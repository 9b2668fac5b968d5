"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def deduplicate(
    df: DataFrame, keys: Sequence[str], order_by: str, descending: bool = True, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The latest (or earliest) row per key by ``order_by``; ``tie_break`` columns decide equal values, highest first.

    ``row_number() = 1`` plans as a partial group limit ahead of the shuffle: each map task sends at most one row
    per key, so a key that owns a third of the table still reaches its reducer as a handful of rows.
    """
    first = F.col(order_by).desc() if descending else F.col(order_by).asc()
    order = [first, *[F.col(c).desc() for c in tie_break]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
