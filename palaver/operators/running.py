"""Running totals over a calendar."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_totals(per_date: DataFrame, date: str, totals: Mapping[str, str]) -> DataFrame:
    """Add ``{new name: summed column}`` cumulated by date, nulls as 0.

    The window has no partition and so runs in one task. Its input must be aggregated to one row per date, which
    bounds it by the length of the calendar, not by the data.
    """
    up_to_now = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_date.withColumns(
        {name: F.sum(F.coalesce(F.col(c), F.lit(0))).over(up_to_now) for name, c in totals.items()}
    )
