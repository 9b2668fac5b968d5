"""Per-conversation analytics.

The source declares this table without formulas. Here: windows are ``createdAt >= as_of - n days``; averages per day
divide by the conversation's age, at least one day; ties for most active sender, hour and type go to the lowest
value; a conversation without messages is 999 days idle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.calendar import HOURS, AsOf, as_date, busiest_hour, days_since, hour_counts
from palaver.functions.columns import fill_columns
from palaver.functions.scores import conversation_health
from palaver.plans.daily import NO_PEAK_HOUR
from palaver.plans.engagement import NEVER_ACTIVE_DAYS


def _within(as_of: AsOf, days: int) -> Column:
    return F.col("createdAt") >= F.date_sub(as_date(as_of), days)


def _most_frequent(value: str, count: str) -> Column:
    """Value with the highest count, the lowest of equals, over rows that are already counted per value."""
    return F.min(F.when(F.col(value).isNotNull(), F.struct(-F.col(count), F.col(value).alias("v")))).getField("v")


def message_profile(messages: DataFrame, as_of: AsOf) -> DataFrame:
    """Totals, hour and type of each conversation: counted per (conversation, type) first, then summed."""
    per_type = messages.groupBy("conversationId", "messageType").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(_within(as_of, 7), 1)).alias("n7"),
        F.count(F.when(_within(as_of, 30), 1)).alias("n30"),
        F.count(F.when(F.col("hasAttachments"), 1)).alias("withMedia"),
        F.sum("reactionCount").alias("reactions"),
        F.max("createdAt").alias("lastAt"),
        *hour_counts("createdAt"),
    )
    summed = per_type.groupBy("conversationId").agg(
        F.sum("n").alias("totalMessages"),
        F.sum("n7").alias("totalMessagesLast7Days"),
        F.sum("n30").alias("totalMessagesLast30Days"),
        F.sum("withMedia").alias("withMedia"),
        F.sum("reactions").alias("reactions"),
        F.max("lastAt").alias("lastAt"),
        _most_frequent("messageType", "n").alias("dominantMessageType"),
        *[F.sum(f"h{h}").alias(f"h{h}") for h in HOURS],
    )
    return summed.withColumn("peakActivityHour", busiest_hour()).drop(*[f"h{h}" for h in HOURS])


def sender_profile(messages: DataFrame, as_of: AsOf) -> DataFrame:
    """Most active sender and senders of the last 7 days: a hot conversation is counted per sender first."""
    per_sender = messages.groupBy("conversationId", "senderId").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(_within(as_of, 7), 1)).alias("n7")
    )
    return per_sender.groupBy("conversationId").agg(
        _most_frequent("senderId", "n").alias("mostActiveParticipantId"),
        F.count(F.when((F.col("n7") > 0) & F.col("senderId").isNotNull(), 1)).alias("uniqueParticipantsLast7Days"),
    )


def conversation_analytics(conversations: DataFrame, messages: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per conversation of the silver table."""
    spine = conversations.select("conversationId", "conversationType", "createdAt", "participantCount")
    joined = spine.join(message_profile(messages, as_of), "conversationId", "left").join(
        sender_profile(messages, as_of), "conversationId", "left"
    )
    counts = [
        "totalMessages", "totalMessagesLast7Days", "totalMessagesLast30Days", "withMedia", "reactions",
        "uniqueParticipantsLast7Days",
    ]
    filled = fill_columns(joined, 0, counts)
    total = F.col("totalMessages").cast("double")
    idle = F.coalesce(days_since(F.col("lastAt"), as_of), F.lit(NEVER_ACTIVE_DAYS))
    final = filled.withColumns({
        "calculationDate": as_date(as_of),
        "avgMessagesPerDay": total / F.greatest(days_since(F.col("createdAt"), as_of), F.lit(1)),
        "avgMessagesPerParticipant": total / F.greatest("participantCount", F.lit(1)),
        "peakActivityHour": F.coalesce("peakActivityHour", F.lit(NO_PEAK_HOUR)),
        "mediaShareRate": F.coalesce(F.try_divide("withMedia", total), F.lit(0.0)),
        "reactionRate": F.coalesce(F.try_divide("reactions", total), F.lit(0.0)),
        "conversationHealth": conversation_health(F.col("totalMessagesLast7Days"), idle),
        "year": F.year(as_date(as_of)),
        "month": F.month(as_date(as_of)),
        "processedAt": F.current_timestamp(),
    })
    return schemas.conform(final, schemas.CONVERSATION_ANALYTICS)
