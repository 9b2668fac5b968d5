"""Per-user engagement: rolling and lifetime totals, network size, score, trend, risk and segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.calendar import AsOf, as_date, days_since
from palaver.functions.columns import fill_columns, since
from palaver.functions.scores import activity_trend, churn_risk, engagement_score, user_segment

# Fixed value: idle days of a user who was never active.
NEVER_ACTIVE_DAYS = 999

# Measure of user_activity -> stem of its total's name.
_TOTALS = {
    "messagesSent": "MessagesSent", "messagesReceived": "MessagesReceived", "reactionsGiven": "ReactionsGiven",
    "reactionsReceived": "ReactionsReceived", "callsInitiated": "CallsInitiated", "callsReceived": "CallsReceived",
}


def _window_sums(as_of: AsOf, days: int) -> list[Column]:
    """Sums over rows dated within ``days`` days before ``as_of``, both ends included; null if there is none."""
    inside = F.col("activityDate") >= F.date_sub(as_date(as_of), days)
    sums = [F.sum(F.when(inside, F.col(m))).alias(f"{m}Last{days}") for m in _TOTALS]
    sums.append(F.sum(F.when(inside, F.col("totalCallDurationMinutes"))).alias(f"callDurationLast{days}"))
    sums.append(F.sum(F.when(inside, F.col("isActiveDay").cast("bigint"))).alias(f"activeDaysLast{days}"))
    return sums


def _daily_average(as_of: AsOf) -> Column:
    recent = F.col("activityDate") >= F.date_sub(as_date(as_of), 30)
    return F.avg(F.when(recent, F.col("messagesSent"))).alias("avgDailyMessagesLast30")


def _lifetime() -> list[Column]:
    sums = [F.sum(m).alias(f"total{stem}") for m, stem in _TOTALS.items()]
    return [
        *sums, F.sum("totalCallDurationMinutes").alias("totalCallDurationMinutes"),
        F.max("activityDate").alias("lastActiveDate"),
    ]


def rolling_activity(activity: DataFrame, as_of: AsOf) -> DataFrame:
    """7- and 30-day totals of every user seen in the last 30 days."""
    recent = since(activity, "activityDate", F.date_sub(as_date(as_of), 30))
    return recent.groupBy("userId").agg(
        *_window_sums(as_of, 7), *_window_sums(as_of, 30),
        F.count_distinct("activityDate").alias("uniqueActiveDaysLast30"), _daily_average(as_of),
    )


def lifetime_totals(activity: DataFrame) -> DataFrame:
    return activity.groupBy("userId").agg(*_lifetime())


def contact_pairs(messages: DataFrame) -> DataFrame:
    """Distinct (userId, conversationId) of messages; the written first contacts hold the same."""
    return messages.select(F.col("senderId").alias("userId"), "conversationId").distinct()


def network_size(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("userId").agg(F.count("conversationId").alias("conversationsParticipating"))


def groups_per_user(pairs: DataFrame, conversations: DataFrame) -> DataFrame:
    """Group conversations each user wrote in."""
    groups = conversations.filter(F.col("conversationType") == "group").select(F.col("_id").alias("conversationId"))
    return pairs.join(groups, "conversationId", "left_semi").groupBy("userId").agg(
        F.count(F.lit(1)).alias("groupsParticipating")
    )


def user_engagement(
    users: DataFrame,
    activity: DataFrame,
    messages: DataFrame,
    as_of: AsOf,
    conversations: DataFrame | None = None,
    cap_score: bool = False,
    pairs: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per user, active or not.

    ``activity`` is read once: both windows and the lifetime totals are conditional sums of one aggregation. With carried
    ``totals`` (``totals.windows_and_lifetime``) it is not read at all.
    ``groupsParticipating`` is 0 unless ``conversations`` are given. The trend compares the last 7 days with the
    days of the 30-day window before them. ``pairs``, the written first contacts, spare a scan of all messages.
    """
    pairs = contact_pairs(messages) if pairs is None else pairs.select("userId", "conversationId").distinct()
    if totals is None:
        totals = activity.groupBy("userId").agg(
            *_window_sums(as_of, 7), *_window_sums(as_of, 30), _daily_average(as_of), *_lifetime()
        )
    joined = users.select("userId").join(totals, "userId", "left").join(network_size(pairs), "userId", "left")
    if conversations is None:
        joined = joined.withColumn("groupsParticipating", F.lit(0).cast("bigint"))
    else:
        joined = joined.join(groups_per_user(pairs, conversations), "userId", "left")
    filled = fill_columns(joined, 0, [c for c in joined.columns if c not in ("userId", "lastActiveDate")])
    idle = F.coalesce(days_since(F.col("lastActiveDate"), as_of), F.lit(NEVER_ACTIVE_DAYS))
    week, month = F.col("messagesSentLast7"), F.col("messagesSentLast30")
    calls = F.col("callsInitiatedLast30") + F.col("callsReceivedLast30")
    active7, active30 = F.col("activeDaysLast7"), F.col("activeDaysLast30")
    final = filled.withColumns({
        "calculationDate": as_date(as_of),
        "avgDailyMessages": F.col("avgDailyMessagesLast30"),
        "avgResponseTimeMinutes": F.lit(None).cast("double"),
        "uniqueContactsMessaged": F.col("conversationsParticipating"),
        "engagementScore": engagement_score(month, F.col("reactionsGivenLast30"), calls, active30, cap=cap_score),
        "activityTrend": activity_trend(week, month - week),
        "churnRisk": churn_risk(active7, active30, idle),
        "userSegment": user_segment(active30, month),
        "year": F.year(as_date(as_of)),
        "month": F.month(as_date(as_of)),
        "processedAt": F.current_timestamp(),
    })
    return schemas.conform(final, schemas.USER_ENGAGEMENT)
