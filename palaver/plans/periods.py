"""Weekly and monthly metrics, rolled up from daily metrics and user activity.

The source declares these tables without formulas; the definitions here are:

* a user is active in a period with at least one active day in it;
* returning: active in this period and the one before; churned: active in the one before only;
* retention rate: returning / active in the period before, null if nobody was;
* weekly engagement score: mean over active users of the engagement score on a 7-day scale;
* stickiness: mean active users per day (days with any) / active users of the month;
* averages per day divide by the calendar length of the period.

``daily`` must be built with ``spine="full"`` so that no day's new users, calls or messages are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.scores import engagement_score


def _week(date: str) -> Column:
    return F.date_trunc("week", F.col(date)).cast("date")


def _month(date: str) -> Column:
    return F.trunc(F.col(date), "month")


def _active_users(activity: DataFrame, period: Column) -> DataFrame:
    """Totals per user and period, active days only; activity holds one row per user and day."""
    return activity.filter("isActiveDay").groupBy("userId", period.alias("period")).agg(
        F.sum("messagesSent").alias("messages"),
        F.sum("reactionsGiven").alias("reactions"),
        F.sum(F.col("callsInitiated") + F.col("callsReceived")).alias("calls"),
        F.count(F.lit(1)).alias("days"),
    )


def _retention(active: DataFrame, following: Column, score: Column) -> DataFrame:
    """Active, returning, previously active and churned users per period.

    Each (user, period) row speaks for its own period and for the one that follows, so no self-join is needed. The
    window holds one row per period of one user.
    """
    timeline = Window.partitionBy("userId").orderBy("period")
    marked = active.withColumn("next", following).withColumns({
        "cameBack": F.coalesce(F.lag("next").over(timeline) == F.col("period"), F.lit(False)),
        "stayed": F.coalesce(F.lead("period").over(timeline) == F.col("next"), F.lit(False)),
        "score": score,
    })
    own = F.struct(
        F.col("period").alias("period"), F.lit(1).alias("active"), F.col("cameBack").cast("int").alias("returning"),
        F.lit(0).alias("previous"), F.lit(0).alias("churned"), F.col("score").alias("score"),
    )
    following_row = F.struct(
        F.col("next").alias("period"), F.lit(0).alias("active"), F.lit(0).alias("returning"),
        F.lit(1).alias("previous"), (~F.col("stayed")).cast("int").alias("churned"),
        F.lit(None).cast("double").alias("score"),
    )
    rows = marked.select(F.explode(F.array(own, following_row)).alias("r")).select("r.*")
    return rows.groupBy("period").agg(
        F.sum("active").alias("activeUsers"), F.sum("returning").alias("returningUsers"),
        F.sum("previous").alias("previousUsers"), F.sum("churned").alias("churnedUsers"),
        F.avg("score").alias("score"),
    )


def _rollup(daily: DataFrame, period: Column, *extra: Column) -> DataFrame:
    return daily.groupBy(period.alias("period")).agg(
        F.max("totalUsers").alias("totalUsers"),
        F.sum("newUsers").alias("newUsers"),
        F.sum("totalMessages").alias("totalMessages"),
        F.sum("totalCalls").alias("totalCalls"),
        (F.sum("totalCallDurationMinutes") / 60.0).alias("totalCallDurationHours"),
        *extra,
    )


def _with_retention(rollup: DataFrame, retention: DataFrame) -> DataFrame:
    joined = rollup.join(retention, "period", "left").fillna(
        0, ["activeUsers", "returningUsers", "previousUsers", "churnedUsers"]
    )
    return joined.withColumns({
        "retentionRate": F.try_divide(F.col("returningUsers").cast("double"), F.col("previousUsers").cast("double")),
        "processedAt": F.current_timestamp(),
    })


def weekly_metrics(daily: DataFrame, activity: DataFrame) -> DataFrame:
    score = engagement_score(F.col("messages"), F.col("reactions"), F.col("calls"), F.col("days"), max_days=7)
    retention = _retention(_active_users(activity, _week("activityDate")), F.date_add("period", 7), score)
    final = _with_retention(_rollup(daily, _week("metricDate")), retention).withColumns({
        "weekStartDate": F.col("period"),
        "weekEndDate": F.date_add("period", 6),
        "weekNumber": F.weekofyear("period"),
        "weeklyActiveUsers": F.col("activeUsers"),
        "avgDailyMessages": F.col("totalMessages") / 7.0,
        "avgDailyActiveCalls": F.col("totalCalls") / 7.0,
        "engagementScore": F.coalesce("score", F.lit(0.0)),
        "year": F.year("period"),
    })
    return schemas.conform(final, schemas.WEEKLY_METRICS)


def message_types_per_month(per_day: DataFrame) -> DataFrame:
    """Message count by type as a map, added up from the maps of the days (``metricDate``, ``messageTypes``)."""
    counted = per_day.select(_month("metricDate").alias("period"), F.explode("messageTypes").alias("messageType", "n"))
    counted = counted.groupBy("period", "messageType").agg(F.sum("n").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct("messageType", "n")))
    return counted.groupBy("period").agg(F.map_from_entries(entries).alias("topMessageTypes"))


def monthly_metrics(daily: DataFrame, activity: DataFrame, message_types: DataFrame) -> DataFrame:
    """``message_types`` has the type counts of days, as ``daily.message_types_per_day`` or the day states do."""
    per_weekday = [
        F.coalesce(F.sum(F.when(F.col("dayOfWeek") == d, F.col("totalMessages"))), F.lit(0)) for d in range(1, 8)
    ]
    rollup = _rollup(
        daily, _month("metricDate"),
        F.avg(F.when(F.col("activeUsers") > 0, F.col("activeUsers"))).alias("meanDailyActive"),
        F.array(*per_weekday).alias("perWeekday"),
    )
    following = F.add_months("period", 1)
    retention = _retention(_active_users(activity, _month("activityDate")), following, F.lit(None).cast("double"))
    joined = _with_retention(rollup, retention).join(message_types_per_month(message_types), "period", "left")
    active = F.col("activeUsers").cast("double")
    final = joined.withColumns({
        "monthDate": F.col("period"),
        "yearMonth": F.date_format("period", "yyyy-MM"),
        "monthlyActiveUsers": F.col("activeUsers"),
        "dauMauRatio": F.try_divide("meanDailyActive", active),
        "avgDailyMessages": F.col("totalMessages") / F.dayofmonth(F.last_day("period")).cast("double"),
        "avgMessagesPerActiveUser": F.try_divide(F.col("totalMessages").cast("double"), active),
        "peakDayOfWeek": F.array_position("perWeekday", F.array_max("perWeekday")),
        "year": F.year("period"),
        "month": F.month("period"),
    })
    return schemas.conform(final, schemas.MONTHLY_METRICS)
