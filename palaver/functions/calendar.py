"""Dates, hours and the explicit clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS = range(24)
AsOf = dt.date | str


def as_date(as_of: AsOf) -> Column:
    return F.lit(str(as_of)).cast("date")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def days_since(column: Column, as_of: AsOf) -> Column:
    return F.datediff(as_date(as_of), column)


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(hours=F.lit(hours))


def hour_counts(ts: str) -> list[Column]:
    """24 conditional counts ``h0`` .. ``h23``: a fixed-width histogram that combines map-side."""
    return [F.expr(f"count_if(hour({ts}) = {h}) AS h{h}") for h in HOURS]


def busiest_hour(ties: str = "first") -> Column:
    """Hour with the highest ``hour_counts`` value; null when there was no row at all.

    ``ties`` picks the earliest (``first``) or the latest (``last``) of equal hours.
    """
    counts = F.array(*[f"h{h}" for h in HOURS])
    top = F.array_max(counts)
    if ties == "first":
        hour = F.array_position(counts, top) - 1
    else:
        hour = len(HOURS) - F.array_position(F.reverse(counts), top)
    return F.when(top > 0, hour.cast("int"))
