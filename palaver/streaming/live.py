"""Live metrics over one-minute windows of bus time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.schemas import STREAM_MESSAGES
from palaver.sources.changes import Keyed
from palaver.streaming.ingest import WATERMARK, parse_values

WINDOW = "1 minute"


def _timed(values: DataFrame, watermark: str, *more: Column) -> DataFrame:
    return parse_values(values, STREAM_MESSAGES, *more).withWatermark("busTimestamp", watermark)


def live_metrics(values: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Message count, active users and conversations, mean length; for update mode.

    Streams have no exact distinct count in one aggregation. The sketches hold a fixed number of bytes per window,
    however many users write.
    """
    start = F.col("window.start")
    per_window = _timed(values, watermark).groupBy(F.window("busTimestamp", window)).agg(
        F.count(F.lit(1)).alias("messageCount"),
        F.approx_count_distinct("senderId").alias("activeUsers"),
        F.approx_count_distinct("conversationId").alias("activeConversations"),
        F.avg(F.length("content")).alias("avgMessageLength"),
    )
    return per_window.select(
        start.alias("windowStart"), F.col("window.end").alias("windowEnd"), "messageCount", "activeUsers",
        "activeConversations", "avgMessageLength", F.year(start).alias("year"), F.month(start).alias("month"),
        F.dayofmonth(start).alias("day"),
    )


# A member row: what one sender, or one conversation, adds to one window.
MEMBER_KEYS = ["windowStart", "kind", "id"]
WINDOW_PARTITIONS = ("year", "month", "day")
# Member rows grow from batch to batch, so the latest batch is current.
MEMBERS = Keyed(
    {"windowStart": "timestamp", "windowEnd": "timestamp", "kind": "string", "id": "string", "n": "bigint",
     "chars": "bigint", "texts": "bigint", "year": "int", "month": "int", "day": "int"},
    MEMBER_KEYS, WINDOW_PARTITIONS,
)


def live_members(
    values: DataFrame, window: str = WINDOW, watermark: str = WATERMARK, keep_window: bool = False
) -> DataFrame:
    """Messages, characters and texts per window and member (sender or conversation), for update mode.

    ``keep_window`` leaves the window column itself, by which a further aggregation of the stream can group.

    State is spread by member, so no window gathers its members into one set. A null sender or conversation is the member
    with an empty id of kind ``unknown sender`` or ``unknown conversation``, spread over slots by the
    whole bus record (a malformed one has no message id), so that a hot null is not one state key.
    """
    slot = F.pmod(F.xxhash64("value", "timestamp"), F.lit(64)).cast("string").alias("slot")

    def member(kind: str, name: str):
        unknown = F.struct(F.lit(f"unknown {kind}").alias("kind"), F.col("slot").alias("id"))
        known = F.struct(F.lit(kind).alias("kind"), F.col(name).alias("id"))
        return F.when(F.col(name).isNull(), unknown).otherwise(known)

    members = F.array(member("sender", "senderId"), member("conversation", "conversationId"))
    rows = _timed(values, watermark, slot).select(
        "busTimestamp", F.length("content").alias("chars"), F.explode(members).alias("m")
    )
    per_member = rows.groupBy(F.window("busTimestamp", window), "m.kind", "m.id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.count("chars").alias("texts")
    )
    if keep_window:
        return per_member
    start = F.col("window.start")
    return per_member.select(
        start.alias("windowStart"), F.col("window.end").alias("windowEnd"), "kind", "id", "n", "chars", "texts",
        F.year(start).alias("year"), F.month(start).alias("month"), F.dayofmonth(start).alias("day"),
    )


def _window_totals(members: DataFrame, *window: str) -> DataFrame:
    sender = F.col("kind").isin("sender", "unknown sender")
    per_window = members.groupBy(*window).agg(
        F.sum(F.when(sender, F.col("n"))).alias("messageCount"),
        F.count_if(F.col("kind") == "sender").alias("activeUsers"),
        F.count_if(F.col("kind") == "conversation").alias("activeConversations"),
        F.sum(F.when(sender, F.col("chars"))).alias("chars"),
        F.sum(F.when(sender, F.col("texts"))).alias("texts"),
    )
    return per_window.withColumn("avgMessageLength", F.try_divide("chars", "texts")).drop("chars", "texts")


def live_metrics_exact(members: DataFrame) -> DataFrame:
    """Exact metrics of every window, open ones included, from the merged table of ``live_members``."""
    return _window_totals(members, "windowStart", "windowEnd")


def live_metrics_final(values: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Exact metrics of every window once it is closed, from one query in append mode.

    Two aggregations follow each other: the first holds one row for each window and member, spread by member; when the
    watermark passes the end of a window they go on to the second, which counts them. Nothing is merged into a table, and
    a row of the result never changes. Windows that the watermark has not passed are not reported, records later than the
    watermark do not count.
    """
    members = live_members(values, window, watermark, keep_window=True)
    totals = _window_totals(members, "window")
    start = F.col("window.start")
    return totals.select(
        start.alias("windowStart"), F.col("window.end").alias("windowEnd"), "messageCount", "activeUsers",
        "activeConversations", "avgMessageLength", F.year(start).alias("year"), F.month(start).alias("month"),
        F.dayofmonth(start).alias("day"),
    )
