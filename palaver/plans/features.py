"""Per-user feature vectors over 1, 7 and 30 days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.arrays import size_or_zero
from palaver.functions.calendar import AsOf, as_date, busiest_hour, days_since, hour_counts
from palaver.functions.columns import fill_columns, since
from palaver.plans.engagement import contact_pairs

# Placeholders and defaults of the feature contract.
GROUP_SIZE_PLACEHOLDER = 5.0
DEFAULT_HOUR = 12
CHURN_AFTER_DAYS = 7


def _from(as_of: AsOf, days: int) -> Column:
    return F.col("activityDate") >= F.date_sub(as_date(as_of), days)


def _total(condition: Column, measure: str) -> Column:
    return F.sum(F.when(condition, F.col(measure)).otherwise(0))


def _windows(as_of: AsOf) -> list[Column]:
    sums = []
    for days in (1, 7, 30):
        inside = _from(as_of, days)
        sums.append(_total(inside, "messagesSent").alias(f"msgSentLast{days}d"))
        sums.append(_total(inside, "messagesReceived").alias(f"msgRecvLast{days}d"))
        if days > 1:
            sums.append(F.count(F.when(inside & F.col("isActiveDay"), 1)).alias(f"activeDaysLast{days}d"))
    # Days outside the window count as 0 minutes and still divide the average.
    minutes = F.when(_from(as_of, 30), F.col("totalCallDurationMinutes")).otherwise(0.0)
    return [*sums, F.avg(minutes).alias("avgSessionDurationMinutes")]


def _momentum(as_of: AsOf) -> list[Column]:
    week = _total(_from(as_of, 7), "messagesSent").cast("double")
    week_before = _total(_from(as_of, 14) & ~_from(as_of, 7), "messagesSent").cast("double")
    return [(week / 7.0).alias("messageVelocity7d"), (week - week_before).alias("engagementTrend")]


def _churn(as_of: AsOf) -> Column:
    """Looks back from ``as_of``; users without any activity row get no label."""
    idle = days_since(F.max("activityDate"), as_of)
    return F.coalesce(idle > CHURN_AFTER_DAYS, F.lit(False)).alias("willChurnNext7d")


def feature_windows(activity: DataFrame, as_of: AsOf) -> DataFrame:
    last_active = F.max(F.when(F.col("isActiveDay"), F.col("activityDate"))).alias("lastActiveDate")
    return activity.groupBy("userId").agg(*_windows(as_of), last_active)


def velocity(activity: DataFrame, as_of: AsOf) -> DataFrame:
    return activity.groupBy("userId").agg(*_momentum(as_of))


def churn_label(activity: DataFrame, as_of: AsOf) -> DataFrame:
    return activity.groupBy("userId").agg(_churn(as_of))


def _sender() -> Column:
    return F.col("senderId").alias("userId")


def _contacts() -> Column:
    return F.count_distinct("conversationId").alias("uniqueContacts")


def _weekday_ratio() -> Column:
    weekday = F.count(F.when(~F.col("isWeekend"), 1)).cast("double")
    return (weekday / F.greatest(F.count(F.lit(1)).cast("double"), F.lit(1.0))).alias("weekdayActivityRatio")


def _last_30_days(messages: DataFrame, as_of: AsOf) -> DataFrame:
    return since(messages, "createdAt", F.date_sub(as_date(as_of), 30))


def social_features(messages: DataFrame, as_of: AsOf) -> DataFrame:
    """Distinct conversations of the last 30 days; group count and size are placeholders."""
    return _last_30_days(messages, as_of).groupBy(_sender()).agg(
        _contacts(), F.lit(0).cast("bigint").alias("groupCount"), F.lit(GROUP_SIZE_PLACEHOLDER).alias("avgGroupSize")
    )


def group_features(pairs: DataFrame, conversations: DataFrame) -> DataFrame:
    """Groups each user ever wrote in and their mean number of participants, instead of the placeholders.

    ``pairs`` are distinct (userId, conversationId). The conversations join as they are written, without an aggregate on
    top, so that adaptive execution can split the pairs of a huge group; versions of one group are merged behind it.
    """
    groups = conversations.filter(F.col("conversationType") == "group").select(
        F.col("_id").alias("conversationId"), size_or_zero(F.col("participants")).alias("members")
    )
    per_group = pairs.join(groups, "conversationId").groupBy("userId", "conversationId").agg(
        F.max("members").alias("members")
    )
    return per_group.groupBy("userId").agg(
        F.count(F.lit(1)).alias("groupCount"), F.avg("members").alias("avgGroupSize")
    )


def temporal_features(messages: DataFrame, as_of: AsOf) -> DataFrame:
    """Most frequent hour (the earliest of equal ones) and the share of weekday messages, last 30 days."""
    counted = _last_30_days(messages, as_of).groupBy(_sender()).agg(
        *hour_counts("createdAt"), _weekday_ratio()
    )
    return counted.select("userId", busiest_hour().alias("preferredHour"), "weekdayActivityRatio")


def user_features(
    activity: DataFrame,
    users: DataFrame,
    messages: DataFrame,
    as_of: AsOf,
    conversations: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """One row per user. Contacts are counted apart from the hours, so that no hour counter goes through the shuffle of
    (user, conversation) pairs.

    ``activity`` must cover ``messages``: whether a user ever wrote is taken from it, which spares a scan of the whole
    message history. With ``conversations``, group count and size are computed instead of the placeholders.
    """
    ever_wrote = F.max(F.when(F.col("messagesSent") > 0, F.lit(GROUP_SIZE_PLACEHOLDER)))
    from_activity = activity.groupBy("userId").agg(
        *_windows(as_of), *_momentum(as_of), _churn(as_of), ever_wrote.alias("avgGroupSize")
    )
    recent = _last_30_days(messages, as_of)
    from_messages = recent.groupBy(_sender()).agg(_weekday_ratio(), *hour_counts("createdAt")).select(
        "userId", "weekdayActivityRatio", busiest_hour().alias("preferredHour")
    )
    contacts = recent.groupBy(_sender()).agg(_contacts())
    joined = users.select("userId").join(from_activity, "userId", "left").join(from_messages, "userId", "left")
    joined = joined.join(contacts, "userId", "left")
    if conversations is None:
        joined = joined.withColumn("groupCount", F.lit(0).cast("bigint"))
    else:
        joined = joined.drop("avgGroupSize").join(
            group_features(contact_pairs(messages) if pairs is None else pairs, conversations), "userId", "left"
        )
    filled = fill_columns(joined, DEFAULT_HOUR, ["preferredHour"])
    filled = fill_columns(filled, 0, [c for c in joined.columns if c not in ("userId", "preferredHour")])
    final = filled.withColumns({"featureDate": as_date(as_of), "processedAt": F.current_timestamp()})
    return schemas.conform(final, schemas.USER_FEATURES)
