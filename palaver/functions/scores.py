"""Business classifications and scores. Thresholds and labels are fixed values of the data contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(steps: Sequence[tuple[Column, str]], default: str) -> Column:
    """First matching condition wins; null conditions do not match."""
    out = F.when(steps[0][0], F.lit(steps[0][1]))
    for condition, label in steps[1:]:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def categorize(value: Column, buckets: Sequence[tuple[float, float, str]]) -> Column:
    """Label of the first half-open bucket ``[low, high)`` that holds the value, else ``unknown``."""
    if not buckets:
        return F.lit("unknown")
    return ladder([((value >= low) & (value < high), label) for low, high, label in buckets], "unknown")


def duration_category(seconds: Column) -> Column:
    return ladder([(seconds < 60, "short"), (seconds < 600, "medium")], "long")


def engagement_score(
    messages: Column, reactions: Column, calls: Column, active_days: Column, max_days: int = 30, cap: bool = False
) -> Column:
    """Points for messages (30 at 100), reactions (20 at 20), calls (20 at 10) and active days (30 at ``max_days``).

    The day term has no ceiling of its own, so 31 active days of 30 give 101; ``cap`` clips the sum to 100.
    """
    def points(measure: Column, full_at: float, worth: float) -> Column:
        return F.least(measure / full_at * worth, F.lit(worth))

    capped = points(messages, 100.0, 30.0) + points(reactions, 20.0, 20.0) + points(calls, 10.0, 20.0)
    total = F.round(capped + active_days.cast("double") / max_days * 30, 2)
    return F.least(total, F.lit(100.0)) if cap else total


def activity_trend(recent: Column, past: Column) -> Column:
    """Compares two totals as they are (no scaling to equal window lengths)."""
    ratio = F.when(past == 0, F.lit(1.0)).otherwise(F.try_divide(recent.cast("double"), past.cast("double")))
    return ladder([(ratio > 1.2, "increasing"), (ratio < 0.8, "decreasing")], "stable")


def churn_risk(active7: Column, active30: Column, idle_days: Column) -> Column:
    slowing = active7 < active30 / 4 * 0.5
    return ladder([(idle_days > 14, "high"), (idle_days > 7, "medium"), (slowing, "medium")], "low")


def user_segment(active30: Column, messages: Column) -> Column:
    return ladder(
        [
            ((active30 >= 25) & (messages >= 100), "power_user"),
            ((active30 >= 15) & (messages >= 30), "regular"),
            (active30 >= 5, "casual"),
            (active30 >= 1, "at_risk"),
        ],
        "churned",
    )


def conversation_health(messages7: Column, idle_days: Column) -> Column:
    return ladder(
        [(idle_days > 30, "dead"), (idle_days > 14, "dying"), (messages7 < 3, "quiet"), (messages7 >= 10, "thriving")],
        "active",
    )
