"""Load only what is newer than the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.calendar import hours_before


def high_water_mark(df: DataFrame, ts: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """One row: the newest timestamp, null for an empty table.

    For a written table whose partition columns (year, month, day) are made of ``ts``, name them: the newest directory is
    found from the columns alone, and only its rows are read.
    """
    if partition_by:
        place = F.lit(0)
        for c in partition_by:
            place = place * 100 + F.col(c)
        df = df.filter(place == df.select(*partition_by).distinct().agg(F.max(place)).scalar())
    return df.agg(F.max(ts).alias("high_water_mark"))


def incremental_load(
    source: DataFrame,
    target: DataFrame | None,
    ts: str,
    as_of: Column,
    lookback_hours: int = 24,
    overlap_hours: int = 0,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Source rows past the target's high-water mark.

    Without a target, or with an empty one, the last ``lookback_hours`` before ``as_of`` are loaded. Rows equal to the
    mark are skipped; ``overlap_hours`` re-reads that much of the tail (late rows) for a following merge. ``partition_by``
    names the target's time partitions where ``ts`` fixes them: then only the newest one is read for the mark.

    The mark is a scalar subquery, so the comparison reaches the source scan as a pushed filter. Spark timestamps
    have microsecond precision: "later than the mark" is "from one microsecond past it".
    """
    first_load = hours_before(as_of, lookback_hours)
    if target is None:
        return source.filter(F.col(ts) >= first_load)
    mark = F.col("high_water_mark")
    step = mark + F.expr("INTERVAL 1 MICROSECOND")
    start = hours_before(mark, overlap_hours) if overlap_hours else step
    threshold = high_water_mark(target, ts, partition_by).select(F.coalesce(start, first_load)).scalar()
    return source.filter(F.col(ts) >= threshold)
