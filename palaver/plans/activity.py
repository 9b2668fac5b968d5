"""Per-user, per-day activity, and the aggregates it is made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.arrays import or_empty
from palaver.functions.columns import time_parts

USER_DAY = ["userId", "activityDate"]


def _day() -> Column:
    return F.to_date("createdAt").alias("activityDate")


def _sender() -> Column:
    return F.col("senderId").alias("userId")


def _sum_where(condition: Column, value: Column | int = 1) -> Column:
    """Conditional sum, 0 where nothing qualifies."""
    amount = value if isinstance(value, Column) else F.lit(value).cast("bigint")
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("bigint")


def message_activity(messages: DataFrame) -> DataFrame:
    return messages.groupBy(_sender(), _day()).agg(
        F.count(F.lit(1)).alias("messagesSent"),
        _sum_where(F.col("hasAttachments")).alias("mediaShared"),
        F.sum("reactionCount").alias("reactionsReceived"),
        F.count_distinct("conversationId").alias("conversationsActive"),
    )


def conversation_day_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("conversationId", _day()).agg(F.count(F.lit(1)).alias("messagesInConv"))


def reactions_by_day(messages: DataFrame) -> DataFrame:
    """Reactions on a sender's own messages, booked as given (the source tables name no giver per silver message)."""
    reacted = messages.filter(F.col("reactionCount") > 0)
    return reacted.groupBy(_sender(), _day()).agg(F.sum("reactionCount").alias("reactionsGiven"))


def reactions_given_true(bronze_messages: DataFrame) -> DataFrame:
    """Reactions by the user who gave them, from the nested reaction lists, on the day of the reaction."""
    given = bronze_messages.select(F.explode("reactions").alias("r"))
    return (
        given.select(F.col("r.userId").alias("userId"), F.to_date("r.createdAt").alias("activityDate"))
        .dropna()
        .groupBy(*USER_DAY)
        .agg(F.count(F.lit(1)).alias("reactionsGiven"))
    )


def calls_initiated(calls: DataFrame) -> DataFrame:
    return calls.groupBy(F.col("initiatorId").alias("userId"), _day()).agg(
        F.count(F.lit(1)).alias("callsInitiated"),
        _sum_where(F.col("status") == "ended", F.col("duration")).alias("totalCallDurationSeconds"),
    )


def calls_received(calls: DataFrame) -> DataFrame:
    taken = calls.select(F.explode("participantIds").alias("userId"), _day()).filter(F.col("userId").isNotNull())
    return taken.groupBy(*USER_DAY).agg(F.count(F.lit(1)).alias("callsReceived"))


def first_touch(messages: DataFrame) -> DataFrame:
    """Conversations in which a user wrote for the first time, by day."""
    started = messages.groupBy(_sender(), "conversationId").agg(F.min(_day()).alias("activityDate"))
    return started.groupBy(*USER_DAY).agg(F.count(F.lit(1)).alias("newConversationsStarted"))


# Measures added up per user and day; every fact row carries all of them.
_MEASURES = (
    "messagesSent", "mediaShared", "reactionsReceived", "reactionsGiven", "conversationsActive",
    "newConversationsStarted", "callsInitiated", "callsReceived", "callSeconds",
)


def _facts(df: DataFrame, measures: dict[str, Column], from_messages: bool) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return df.select(
        *USER_DAY, *[measures.get(m, zero).cast("bigint").alias(m) for m in _MEASURES],
        F.lit(from_messages).alias("fromMessages"),
    )


def first_contacts(messages: DataFrame) -> DataFrame:
    """The first day on which each user wrote in each conversation."""
    pairs = messages.groupBy(_sender(), "conversationId").agg(F.min(F.to_date("createdAt")).alias("firstDay"))
    parts = time_parts("firstDay")
    return schemas.conform(pairs.withColumns({p: parts[p] for p in schemas.DAY_PARTITIONS}), schemas.FIRST_CONTACTS)


def new_contacts(recent: DataFrame, contacts: DataFrame, day: Column) -> DataFrame:
    """First contacts from ``day`` on, from the messages of those days alone: pairs with an earlier contact are left out."""
    old = contacts.filter(F.col("firstDay") < day).select("userId", "conversationId")
    return first_contacts(recent).join(old, ["userId", "conversationId"], "left_anti").select(*schemas.FIRST_CONTACTS)


def message_facts(messages: DataFrame, contacts: DataFrame | None = None) -> DataFrame:
    """One row per (user, conversation, day), so that one pass over messages serves every message measure.

    The window finds each user's first day in a conversation; its groups hold one row per calendar day at most. With
    ``contacts``, the first contacts of the same days, there is no window and ``messages`` need not hold the history.
    """
    cube = messages.groupBy(_sender(), "conversationId", _day()).agg(
        F.count(F.lit(1)).alias("n"),
        _sum_where(F.col("hasAttachments")).alias("media"),
        F.sum("reactionCount").alias("reactions"),
        F.sum(F.when(F.col("reactionCount") > 0, F.col("reactionCount"))).alias("given"),
    )
    if contacts is None:
        first_day = F.min("activityDate").over(Window.partitionBy("userId", "conversationId"))
        marked = cube.withColumn("isFirst", F.col("activityDate") == first_day)
    else:
        marked = cube.withColumn("isFirst", F.lit(False))
    facts = _facts(marked, {
        "messagesSent": F.col("n"),
        "mediaShared": F.col("media"),
        "reactionsReceived": F.col("reactions"),
        "reactionsGiven": F.col("given"),
        "conversationsActive": F.col("conversationId").isNotNull().cast("int"),
        "newConversationsStarted": F.col("isFirst").cast("int"),
    }, from_messages=True)
    if contacts is None:
        return facts
    started = contacts.groupBy("userId", "conversationId").agg(F.min("firstDay").alias("activityDate"))
    return facts.unionByName(_facts(started, {"newConversationsStarted": F.lit(1)}, from_messages=True))


def call_facts(calls: DataFrame) -> DataFrame:
    """One row per person in a call: the initiator, then every participant."""
    seconds = F.when(F.col("status") == "ended", F.coalesce("duration", F.lit(0))).otherwise(F.lit(0))

    def role(person: Column, initiated: int, received: int, duration: Column) -> Column:
        return F.struct(
            person.alias("userId"), F.lit(initiated).alias("initiated"), F.lit(received).alias("received"),
            duration.cast("bigint").alias("seconds"),
        )

    people = F.concat(
        F.array(role(F.col("initiatorId"), 1, 0, seconds)),
        F.transform(or_empty(F.col("participantIds"), schemas.STRINGS), lambda p: role(p, 0, 1, F.lit(0))),
    )
    rows = calls.select(_day(), F.explode(people).alias("p")).select("activityDate", "p.*").dropna(subset=USER_DAY)
    return _facts(rows, {
        "callsInitiated": F.col("initiated"), "callsReceived": F.col("received"), "callSeconds": F.col("seconds"),
    }, from_messages=False)


def user_activity(
    messages: DataFrame, calls: DataFrame, spine: str = "messages", contacts: DataFrame | None = None
) -> DataFrame:
    """Activity per user and day; of some days only, when ``contacts`` holds the first contacts of these days.

    ``spine="messages"`` keeps days on which the user wrote a message; ``spine="full"`` also keeps days with only
    calls. Message and call facts are stacked and summed in one aggregation instead of joined: partial sums are
    built before the shuffle, so neither a hot user nor a hot day gathers raw rows.
    """
    if spine not in ("messages", "full"):
        raise ValueError(f"unknown spine: {spine}")
    facts = message_facts(messages, contacts).unionByName(call_facts(calls))
    summed = facts.groupBy(*USER_DAY).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _MEASURES], F.max("fromMessages").alias("fromMessages")
    )
    rows = summed.filter("fromMessages") if spine == "messages" else summed
    active = (F.col("messagesSent") > 0) | (F.col("callsInitiated") > 0) | (F.col("callsReceived") > 0)
    final = rows.withColumns({
        "messagesReceived": F.lit(0),
        "totalCallDurationMinutes": F.col("callSeconds") / 60.0,
        "isActiveDay": active,
        "processedAt": F.current_timestamp(),
        **time_parts("activityDate"),
    })
    return schemas.conform(final, schemas.USER_ACTIVITY)
