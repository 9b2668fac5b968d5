"""Silver layer: deduplicated, validated and enriched entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.arrays import distinct_members, member_field, or_empty, size_or_zero
from palaver.functions.calendar import AsOf, days_since
from palaver.functions.columns import require, time_parts
from palaver.functions.scores import duration_category
from palaver.operators.dedup import deduplicate
from palaver.operators.enrich import lookup

ACTIVE_WITHIN_DAYS = 30


def _filled(name: str):
    return F.col(name).isNotNull() & (F.col(name) != "")


def message_measures() -> dict:
    """Counts and flags read off one message's nested columns."""
    attachments, reactions = F.col("attachments"), F.col("reactions")
    return {
        "contentLength": F.coalesce(F.length("content"), F.lit(0)),
        "hasAttachments": size_or_zero(attachments) > 0,
        "attachmentCount": size_or_zero(attachments),
        "attachmentTypes": or_empty(member_field(attachments, "type"), schemas.STRINGS),
        "reactionCount": size_or_zero(reactions),
        "uniqueReactors": distinct_members(reactions, "userId"),
        "isReply": F.col("replyTo").isNotNull(),
        "readCount": size_or_zero(F.col("readBy")),
    }


def latest_messages(messages: DataFrame) -> DataFrame:
    """Latest valid version of every message, with its measures.

    Measures are taken before deduplication: attachments, reactions and reader lists stay out of the shuffle.
    """
    measured = messages.withColumns(message_measures()).drop(
        "attachments", "reactions", "readBy", "expiresAt", "ingestTimestamp", "sourceSystem", "year", "month", "day"
    )
    latest = deduplicate(measured, ["_id"], "updatedAt", tie_break=["createdAt", "messageType", "content"])
    valid = require(latest, ["_id", "conversationId", "senderId", "createdAt"])
    return valid.withColumnsRenamed({"_id": "messageId", "replyTo": "replyToMessageId"}).withColumns(
        time_parts("createdAt")
    )


def silver_messages(messages: DataFrame, users: DataFrame) -> DataFrame:
    """Latest messages with the sender's name. ``users`` is the written bronze table, one row per ``_id``.

    Names are looked up for the pairs of message and sender, and these come to the messages where deduplication has
    placed them: texts are not shuffled again by sender. Of the join's condition only the message is an equality, so that
    the placement by message serves it; the two comparisons pick the sender of the version that stays.
    """
    names = users.select("_id", F.col("displayName").alias("senderName"))
    senders = messages.select(F.col("_id").alias("_message"), F.col("senderId").alias("_sender")).dropna()
    # Several versions of a message name a sender; one placement by message serves them and the join.
    named = lookup(senders, "_sender", names, "_id").repartition("_message").distinct()
    latest, sender = latest_messages(messages), F.col("senderId")
    same = (F.col("messageId") == F.col("_message")) & (sender <= F.col("_sender")) & (sender >= F.col("_sender"))
    joined = latest.join(named, same, "left").drop("_message", "_sender")
    return schemas.conform(joined.withColumn("processedAt", F.current_timestamp()), schemas.SILVER_MESSAGES)


def silver_users(users: DataFrame, as_of: AsOf) -> DataFrame:
    latest = deduplicate(users, ["_id"], "updatedAt", tie_break=["createdAt", "email"])
    valid = require(latest, ["_id", "createdAt"])
    final = valid.withColumnRenamed("_id", "userId").withColumns({
        "hasAvatar": _filled("avatar"),
        "hasBio": _filled("bio"),
        "lastSeenDaysAgo": days_since(F.col("lastSeen"), as_of),
        "accountAgeDays": days_since(F.col("createdAt"), as_of),
        "processedAt": F.current_timestamp(),
        **{p: time_parts("createdAt")[p] for p in schemas.MONTH_PARTITIONS},
    })
    return schemas.conform(final, schemas.SILVER_USERS)


def silver_conversations(conversations: DataFrame, as_of: AsOf) -> DataFrame:
    latest = deduplicate(conversations, ["_id"], "updatedAt", tie_break=["createdAt", "conversationType"])
    valid = require(latest, ["_id", "createdAt"])
    idle = days_since(F.col("lastMessageAt"), as_of)
    final = valid.withColumnRenamed("_id", "conversationId").withColumns({
        "hasAvatar": _filled("avatar"),
        "participantCount": size_or_zero(F.col("participants")),
        "adminCount": size_or_zero(F.col("admins")),
        "hasLastMessage": F.col("lastMessageId").isNotNull(),
        "daysSinceLastMessage": idle,
        "isActive": F.coalesce(idle <= ACTIVE_WITHIN_DAYS, F.lit(False)),
        "conversationAgeDays": days_since(F.col("createdAt"), as_of),
        "processedAt": F.current_timestamp(),
        **{p: time_parts("createdAt")[p] for p in schemas.MONTH_PARTITIONS},
    })
    return schemas.conform(final, schemas.SILVER_CONVERSATIONS)


def silver_calls(calls: DataFrame) -> DataFrame:
    latest = deduplicate(calls, ["_id"], "createdAt", tie_break=["endTime", "status", "duration"])
    valid = require(latest, ["_id", "createdAt"])
    final = valid.withColumnRenamed("_id", "callId").withColumns({
        "participantCount": size_or_zero(F.col("participantIds")),
        "isCompleted": F.col("status") == "ended",
        "isMissed": F.col("status") == "missed",
        "durationSeconds": F.col("duration"),
        "durationMinutes": F.col("duration") / 60.0,
        "durationCategory": duration_category(F.col("duration")),
        "processedAt": F.current_timestamp(),
        **time_parts("createdAt"),
    })
    return schemas.conform(final, schemas.SILVER_CALLS)
