"""Platform metrics per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.calendar import busiest_hour, hour_counts
from palaver.functions.columns import fill_columns, time_parts
from palaver.operators.running import running_totals

# What a day without messages reports, and the session placeholder.
NO_PEAK_HOUR = 12
SESSIONS_PER_USER = 1.0


def _on(ts: str) -> Column:
    return F.to_date(ts).alias("metricDate")


def _rows_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def new_per_day(entities: DataFrame, name: str) -> DataFrame:
    return entities.groupBy(_on("createdAt")).agg(F.count(F.lit(1)).alias(name))


def distinct_user_dates(users: DataFrame) -> DataFrame:
    return users.select("userId", F.to_date("createdAt").alias("createdDate")).distinct()


def active_users_per_day(activity: DataFrame) -> DataFrame:
    active = activity.filter("isActiveDay")
    return active.groupBy(F.col("activityDate").alias("metricDate")).agg(
        F.count("userId").alias("activeUsers"),  # activity holds one row per user and day
        F.sum("messagesSent").alias("totalMessagesSent"),
        F.avg("messagesSent").alias("avgMessagesPerUser"),
    )


def message_mix(messages: DataFrame) -> DataFrame:
    return messages.groupBy(_on("createdAt")).agg(*_mix())


def _mix() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("totalMessages"),
        _rows_where(F.col("messageType") == "text").alias("textMessages"),
        _rows_where(F.col("messageType").isin(*schemas.MEDIA_TYPES)).alias("mediaMessages"),
        F.sum("reactionCount").alias("totalReactions"),
    ]


def peak_hour_per_day(messages: DataFrame) -> DataFrame:
    """Hour with most messages; of equal hours the later one."""
    counted = messages.groupBy(_on("createdAt")).agg(*hour_counts("createdAt"))
    return counted.select("metricDate", busiest_hour(ties="last").alias("peakHour"))


def active_conversations_per_day(messages: DataFrame) -> DataFrame:
    return messages.groupBy(_on("createdAt")).agg(F.count_distinct("conversationId").alias("activeConversations"))


def message_metrics(messages: DataFrame) -> DataFrame:
    """Mix and peak hour: one pass that combines to a few rows per task, the histogram being 24 counters."""
    per_day = messages.groupBy(_on("createdAt")).agg(*_mix(), *hour_counts("createdAt"))
    return per_day.withColumn("peakHour", busiest_hour(ties="last")).select(
        "metricDate", "totalMessages", "textMessages", "mediaMessages", "totalReactions", "peakHour"
    )


def call_metrics(calls: DataFrame) -> DataFrame:
    """Calls by type and their length; a call without a duration counts as 0 seconds, also in the average."""
    seconds = F.coalesce("duration", F.lit(0))
    return calls.groupBy(_on("createdAt")).agg(
        F.count(F.lit(1)).alias("totalCalls"),
        _rows_where(F.col("callType") == "audio").alias("audioCalls"),
        _rows_where(F.col("callType") == "video").alias("videoCalls"),
        (F.sum(seconds) / 60.0).alias("totalCallDurationMinutes"),
        (F.avg(seconds) / 60.0).alias("avgCallDurationMinutes"),
    )


def message_types_per_day(messages: DataFrame) -> DataFrame:
    """Message count by type as a map; the list it is built from has one entry per type."""
    counted = messages.filter(F.col("messageType").isNotNull()).groupBy(_on("createdAt"), "messageType").agg(
        F.count(F.lit(1)).alias("n")
    )
    entries = F.array_sort(F.collect_list(F.struct("messageType", "n")))
    return counted.groupBy("metricDate").agg(F.map_from_entries(entries).alias("messageTypes"))


def day_states(messages: DataFrame, activity: DataFrame, calls: DataFrame) -> DataFrame:
    """What messages, activity and calls add to each day: one row for each day on which there was any.

    A day's row depends on that day alone, so rows of days without changes can be kept from run to run. Daily, weekly and
    monthly metrics are made of these rows. Messages are read three times on purpose: counting conversations and types
    shuffles one narrow row per group, and the other measures next to nothing.
    """
    joined = active_users_per_day(activity).filter(F.col("metricDate").isNotNull())
    for side in (
        message_metrics(messages), active_conversations_per_day(messages), message_types_per_day(messages),
        call_metrics(calls),
    ):
        joined = joined.join(side.filter(F.col("metricDate").isNotNull()), "metricDate", "full")
    return schemas.conform(joined.withColumns(time_parts("metricDate")), schemas.DAY_STATES)


def daily_metrics(
    messages: DataFrame,
    users: DataFrame,
    activity: DataFrame,
    calls: DataFrame,
    conversations: DataFrame,
    spine: str = "dau",
) -> DataFrame:
    """Metrics per day straight from the tables; see ``daily_from_states``."""
    return daily_from_states(day_states(messages, activity, calls), users, conversations, spine)


def daily_from_states(states: DataFrame, users: DataFrame, conversations: DataFrame, spine: str = "dau") -> DataFrame:
    """One row per day.

    ``spine="dau"`` reports days with active users, and only those days feed the running totals; ``spine="full"``
    reports every day on which anything happened. All joins are between per-day rows. Users and conversations may be
    entered late, for days long gone, so their new ones are counted over the whole (narrow) tables.
    """
    if spine not in ("dau", "full"):
        raise ValueError(f"unknown spine: {spine}")
    how = "left" if spine == "dau" else "full"
    joined = (states.filter("activeUsers IS NOT NULL") if spine == "dau" else states).drop("messageTypes", "year", "month")
    for side in (new_per_day(users, "newUsers"), new_per_day(conversations, "newConversations")):
        joined = joined.join(side.filter(F.col("metricDate").isNotNull()), "metricDate", how)
    totals = running_totals(
        joined, "metricDate", {"totalUsers": "newUsers", "totalConversations": "newConversations"}
    )
    counts = [
        "activeUsers", "newUsers", "totalMessages", "textMessages", "mediaMessages", "totalCalls", "audioCalls",
        "videoCalls", "totalReactions", "newConversations", "activeConversations",
    ]
    filled = fill_columns(totals, 0, counts)
    filled = fill_columns(filled, 0.0, ["totalCallDurationMinutes", "avgCallDurationMinutes", "avgMessagesPerUser"])
    final = filled.withColumns({
        "peakHour": F.coalesce("peakHour", F.lit(NO_PEAK_HOUR)),
        "avgSessionsPerUser": F.lit(SESSIONS_PER_USER),
        "processedAt": F.current_timestamp(),
        **time_parts("metricDate"),
    })
    return schemas.conform(final, schemas.DAILY_METRICS)
