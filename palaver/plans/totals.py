"""Totals per user carried from run to run: 7 and 30 days and lifetime, updated by the days that enter, leave or change.

A state row holds a user's sums as of a date. The next state is the sum of the old one and of signed days: a changed day's
old version is subtracted and its new one added, a day that a window's start has passed is subtracted from that window. So a
run reads the changed days, the days that left the windows and one row for each user, whatever the length of the history.

All sums are whole numbers (calls in seconds), so adding and subtracting leaves no rounding behind. Measures of
``user_activity`` are never null there; a null counts 0. Rows without a user are one user of their own, as in a grouping.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.calendar import AsOf, as_date
from palaver.functions.columns import since
from palaver.sources.tables import staged

WINDOWS = schemas.TOTAL_WINDOWS
_STATE_SUMS = [c for c, kind in schemas.USER_TOTALS.items() if kind == "bigint"]


def _amounts() -> dict[str, Column]:
    """What one day of a user adds to each sum."""
    amounts = {m: F.col(m) for m in schemas.TOTAL_MEASURES}
    amounts["callSeconds"] = F.round(F.col("totalCallDurationMinutes") * 60)
    amounts["activeDays"] = F.col("isActiveDay")
    amounts["days"] = F.lit(1)
    return {name: F.coalesce(amount.cast("bigint"), F.lit(0)) for name, amount in amounts.items()}


def _inside(as_of: AsOf, days: int) -> Column:
    """1 for a date in the window of ``days`` days before ``as_of``, both ends included, else 0."""
    return F.coalesce((F.col("activityDate") >= F.date_sub(as_date(as_of), days)).cast("bigint"), F.lit(0))


def _signed(rows: DataFrame, lifetime: int, window: Callable[[int], Column], latest: bool = False) -> DataFrame:
    """Rows of activity as what they add to a state; ``latest`` rows can be a user's last active day."""
    sums = []
    for name, amount in _amounts().items():
        sums += [(amount * window(w)).alias(f"{name}Last{w}") for w in WINDOWS]
        sums.append((amount * F.lit(lifetime)).alias(f"{name}Total"))
    last = F.col("activityDate") if latest else F.lit(None).cast("date")
    return rows.select("userId", *sums, last.alias("fresh"), F.lit(None).cast("date").alias("kept"))


def _summed(parts: list[DataFrame]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("userId").agg(
        *[F.sum(c).alias(c) for c in _STATE_SUMS], F.max("fresh").alias("fresh"), F.max("kept").alias("kept")
    )


def user_totals(activity: DataFrame, as_of: AsOf) -> DataFrame:
    """The state as of a date, summed over all days."""
    summed = _summed([_signed(activity, 1, lambda w: _inside(as_of, w), latest=True)])
    return _state(summed.withColumn("lastActiveDate", F.col("fresh")), as_of)


def _state(df: DataFrame, as_of: AsOf) -> DataFrame:
    return schemas.conform(df.withColumn("asOf", as_date(as_of)), schemas.USER_TOTALS)


def crossing_days(activity: DataFrame, before: dt.date, as_of: dt.date, until: dt.date) -> DataFrame:
    """Rows earlier than ``until`` that are in a window as of one of the two dates and outside of it as of the other."""
    low, high = min(before, as_of), max(before, as_of)
    crossed = F.lit(False)
    for days in WINDOWS:
        start, end = (F.date_sub(as_date(d), days) for d in (low, high))
        crossed = crossed | ((F.col("activityDate") >= start) & (F.col("activityDate") < end))
    return since(activity, "activityDate", F.date_sub(as_date(low), max(WINDOWS))).filter(
        crossed & (F.col("activityDate") < F.lit(until))
    )


def carry_totals(state: DataFrame, old_days: DataFrame, activity: DataFrame, first: dt.date, as_of: AsOf) -> DataFrame:
    """The state as of ``as_of``, from an earlier (or later) ``state`` and the days from ``first`` on.

    ``old_days`` are the rows from ``first`` on that ``state`` was made of, ``activity`` is the table as it is now; earlier
    days are the same in both. The result is written to a scratch table. Users without any day left go. Only where a user
    lost all days from ``first`` on, and with them the last active one, is the earlier history of such users read.
    """
    before = state.agg(F.max("asOf")).first()[0]
    if before is None:
        return user_totals(activity, as_of)
    target = dt.date.fromisoformat(str(as_of))
    now = since(activity, "activityDate", F.lit(first))
    parts = [
        state.select("userId", *_STATE_SUMS, F.lit(None).cast("date").alias("fresh"), F.col("lastActiveDate").alias("kept")),
        _signed(old_days, -1, lambda w: -_inside(before, w)),
        _signed(now, 1, lambda w: _inside(as_of, w), latest=True),
    ]
    if before != target:
        crossed = crossing_days(activity, before, target, first)
        parts.append(_signed(crossed, 0, lambda w: _inside(as_of, w) - _inside(before, w)))
    earlier = F.when(F.col("kept") < F.lit(first), F.col("kept"))
    last = F.greatest(earlier, F.col("fresh"))
    carried = staged(_state(_summed(parts).filter("daysTotal > 0").withColumn("lastActiveDate", last), as_of), "totals")
    lost = carried.filter("lastActiveDate IS NULL").select("userId")
    if lost.isEmpty():
        return carried
    history = activity.filter(F.col("activityDate") < F.lit(first)).select("userId", "activityDate")
    theirs = history.join(lost, history["userId"].eqNullSafe(lost["userId"]), "left_semi")
    found = theirs.groupBy(F.col("userId").alias("_user")).agg(F.max("activityDate").alias("_last"))
    joined = carried.join(found, carried["userId"].eqNullSafe(found["_user"]), "left")
    return schemas.conform(joined.withColumn("lastActiveDate", F.coalesce("lastActiveDate", "_last")), schemas.USER_TOTALS)


def windows_and_lifetime(state: DataFrame) -> DataFrame:
    """A state under the names of ``rolling_activity`` and ``lifetime_totals``; sums of a window without days are null."""
    out = [F.col("userId")]
    for w in WINDOWS:
        seen = F.col(f"daysLast{w}") > 0
        out += [F.when(seen, F.col(f"{m}Last{w}")).alias(f"{m}Last{w}") for m in (*schemas.TOTAL_MEASURES, "activeDays")]
        out.append(F.when(seen, F.col(f"callSecondsLast{w}") / 60.0).alias(f"callDurationLast{w}"))
    mean = F.col("messagesSentLast30") / F.col("daysLast30")
    out.append(F.when(F.col("daysLast30") > 0, mean).alias("avgDailyMessagesLast30"))
    out += [F.col(f"{m}Total").alias(f"total{m[0].upper()}{m[1:]}") for m in schemas.TOTAL_MEASURES]
    return state.select(*out, (F.col("callSecondsTotal") / 60.0).alias("totalCallDurationMinutes"), "lastActiveDate")
