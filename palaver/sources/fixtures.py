"""Chat inputs derived from the driver's tables, by plain rules that SQL can repeat.

Messages come from events, users and auth accounts from customers, conversations from conversations, calls from
orders and line items. Every frame is built over whole tables and is lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver import schemas
from palaver.operators.enrich import lookup_spread
from palaver.operators.layout import balance

AS_OF = "2024-01-31"
# JSON is written with microseconds; the default keeps milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _count_of(df: DataFrame, column: str) -> Column:
    return df.agg(F.count_distinct(column)).scalar()


def _repeat(n: str, member: str, dtype: str) -> str:
    """SQL for the array of ``member`` (an expression in ``i``) for i = 0 .. n-1."""
    return f"CAST(IF({n} > 0, transform(sequence(0, CAST({n} AS INT) - 1), i -> {member}), array()) AS {dtype})"


# First day and number of days that a user class is active in, by ``user_id % 10``; days count from DAY_ZERO.
DAY_ZERO = "DATE '2024-01-01'"
ACTIVE_DAYS = {1: (0, 20), 2: (0, 12), 3: (21, 10), 4: (16, 15), 6: (0, 20), 7: (0, 3), 8: (21, 10), 9: (16, 15)}


def shaped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, moved by whole days into the days of their user's class, so that every trend, risk and segment occurs.

    Users with ``user_id % 5 = 0`` stay where they are and get each event twice, the copy 30 minutes later with suffix
    ``-2``.
    """
    day = f"datediff(ts, {DAY_ZERO})"
    moved = " ".join(
        f"WHEN {u} THEN {first} + pmod({day}, {days}) - {day}" for u, (first, days) in ACTIVE_DAYS.items()
    )
    at = f"CAST(ts AS TIMESTAMP) + make_dt_interval(CASE user_id % 10 {moved} ELSE 0 END)"
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "CAST(get_json_object(props, '$.k') AS INT) AS k", f"{at} AS moved"
    )
    once = "named_struct('id', CAST(event_id AS STRING), 'at', moved)"
    copy = "named_struct('id', event_id || '-2', 'at', moved + INTERVAL 30 MINUTES)"
    # Few files of narrow rows become wide messages: they are spread while they are narrow.
    return balance(events).selectExpr(
        "event_id", "user_id", "event_type", "k",
        f"inline(IF(user_id % 5 = 0, array({once}, {copy}), array({once})))",
    )


def raw_messages(spark: SparkSession, sf_dir: str, versions: bool = True) -> DataFrame:
    """Message documents. With ``versions``, every tenth message also has an edited version one hour later."""
    conversations = table(spark, sf_dir, "conversations")
    # An event tells one turn of its conversation, so that all turns are told where there are events enough.
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "text")) - 1
    texts = conversations.select(F.concat_ws(":", "conv_id", place).alias("told"), "text")
    turns = conversations.groupBy(F.col("conv_id").cast("string").alias("conversationId")).agg(F.count(F.lit(1)).alias("turns"))
    conversation = F.expr("user_id * 7 + k") % _count_of(conversations, "conv_id")
    events = shaped_events(spark, sf_dir).withColumn("conversationId", conversation.cast("string"))
    events = events.join(turns, "conversationId", "left")
    events = events.withColumn("tells", F.expr("conversationId || ':' || event_id % turns"))

    def attachment(kind: str) -> str:
        return (
            f"named_struct('type', '{kind}', 'url', 'https://media.example.com/{kind}-' || id, "
            f"'filename', '{kind}-' || id, 'size', event_id * 10, 'mimeType', '{kind}/any', "
            "'thumbnailUrl', CAST(NULL AS STRING))"
        )

    reaction = "named_struct('userId', CAST((user_id + i) % 3 AS STRING), 'emoji', 'e' || i, 'createdAt', at)"
    first = "named_struct('updatedAt', at, 'isEdited', CAST(NULL AS BOOLEAN))"
    edited = "named_struct('updatedAt', at + INTERVAL 1 HOUR, 'isEdited', true)"
    history = f"IF(event_id % 10 = 0, array({first}, {edited}), array({first}))" if versions else f"array({first})"
    documents = lookup_spread(events, "tells", "id", texts, "told", copies=4).selectExpr(
        "named_struct('oid', id) AS _id",
        "conversationId",
        "CAST(user_id AS STRING) AS senderId",
        """CASE event_type WHEN 'click' THEN 'text' WHEN 'view' THEN 'image' WHEN 'purchase' THEN 'video'
             WHEN 'signup' THEN 'file' WHEN 'error' THEN 'system' END AS type""",
        "IF(k % 10 = 0, NULL, text) AS content",
        f"""CAST(CASE event_type WHEN 'view' THEN array({attachment('image')})
             WHEN 'purchase' THEN array({attachment('video')}, {attachment('image')})
             WHEN 'error' THEN NULL ELSE array() END AS {schemas.ATTACHMENTS}) AS attachments""",
        f"{_repeat('k % 4', reaction, schemas.REACTIONS)} AS reactions",
        "IF(k % 5 = 0, CAST(event_id - 1 AS STRING), NULL) AS replyTo",
        "k = 99 AS isDeleted",
        "IF(k % 13 = 0, true, NULL) AS isForwarded",
        f"{_repeat('k % 3', 'CAST(user_id + i + 1 AS STRING)', schemas.STRINGS)} AS readBy",
        "at AS createdAt",
        "IF(k % 20 = 0, at + INTERVAL 1 DAY, NULL) AS expiresAt",
        f"inline({history})",
    )
    return documents.select(*schemas.RAW_MESSAGES)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = "TIMESTAMP '2023-12-15' + make_dt_interval(CAST(c_custkey % 45 AS INT))"
    seen = "TIMESTAMP '2023-12-15' + make_dt_interval(CAST(c_custkey % 45 + c_custkey % 10 AS INT))"
    return table(spark, sf_dir, "customer").selectExpr(
        "named_struct('oid', CAST(c_custkey AS STRING)) AS _id",
        "'+1' || lpad(CAST(c_custkey AS STRING), 10, '0') AS phoneNumber",
        "IF(c_custkey % 50 = 0, NULL, lower(c_name) || '@example.com') AS email",
        "lower(c_name) AS username",
        "c_name AS displayName",
        "CASE c_custkey % 3 WHEN 1 THEN '' WHEN 2 THEN 'https://a.example.com/' || c_custkey END AS avatar",
        "CASE c_custkey % 4 WHEN 0 THEN 'bio of ' || c_name WHEN 1 THEN '' END AS bio",
        "IF(c_custkey % 6 = 0, 'busy', NULL) AS status",
        f"IF(c_custkey % 7 = 0, NULL, {seen}) AS lastSeen",
        "IF(c_custkey % 5 = 0, NULL, c_custkey % 5 = 1) AS isOnline",
        "IF(c_custkey % 11 = 0, NULL, c_mktsegment) AS role",
        "IF(c_custkey % 9 = 0, true, NULL) AS isBanned",
        "c_custkey % 2 = 0 AS isVerified",
        f"{created} AS createdAt",
        f"{created} AS updatedAt",
    )


def raw_auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An account for every customer, of every second one under another email than the user's; every tenth customer has
    an older account under the same email."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "*", "explode(IF(c_custkey % 10 = 0, array(0, 1), array(0))) AS old"
    )
    return rows.selectExpr(
        "c_custkey * 2 + old AS id",
        "IF(c_custkey % 2 = 0, '', 'work-') || lower(c_name) || '@example.com' AS email",
        "c_custkey % 4 = 0 AS email_verified",
        "c_custkey % 6 = 0 AS two_factor_enabled",
        "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(c_custkey % 28 - old AS INT)) AS last_login_at",
        "CAST(abs(c_acctbal) AS BIGINT) AS login_count",
        "TIMESTAMP '2023-12-01' AS created_at",
    )


def raw_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation documents. Groups have more than four turns; participants are two, or three to ten by the group's id."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    last = raw_messages(spark, sf_dir, versions=False).groupBy("conversationId").agg(
        F.max("createdAt").alias("lastAt")
    )
    joined = turns.withColumn("conversationId", F.expr("CAST(conv_id AS STRING)")).join(last, "conversationId", "left")
    created = "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(conv_id % 30 AS INT))"
    return joined.selectExpr(
        "named_struct('oid', conversationId) AS _id",
        "IF(turns > 4, 'group', 'single') AS type",
        "IF(turns > 4, 'group ' || conv_id, NULL) AS name",
        "CASE conv_id % 3 WHEN 1 THEN '' WHEN 2 THEN 'https://c.example.com/' || conv_id END AS avatar",
        f"{_repeat('IF(turns > 4, 3 + conv_id % 8, 2)', 'CAST(conv_id + i AS STRING)', schemas.STRINGS)} AS participants",
        "IF(conv_id % 4 = 0, NULL, array(CAST(conv_id AS STRING))) AS admins",
        "IF(conv_id % 5 = 0, NULL, 'last-' || conv_id) AS lastMessageId",
        "IF(conv_id % 5 = 0, NULL, lastAt) AS lastMessageAt",
        "IF(conv_id % 6 = 0, true, NULL) AS isArchived",
        "CAST(NULL AS BOOLEAN) AS isLocked",
        "CAST(conv_id AS STRING) AS createdBy",
        f"{created} AS createdAt",
        f"{created} AS updatedAt",
    )


def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call documents, one for each order; all suppliers of its lines take part."""
    orders = table(spark, sf_dir, "orders")
    people = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))).alias("participantIds")
    )
    n_users = _count_of(table(spark, sf_dir, "events"), "user_id")
    calls = orders.join(people, "o_orderkey", "left").withColumn("initiator", F.col("o_custkey") % n_users).selectExpr(
        "*",
        "CASE o_orderstatus WHEN 'F' THEN 'ended' WHEN 'O' THEN 'ongoing' WHEN 'P' THEN 'missed' END AS status",
        """TIMESTAMP '2024-01-01'
             + make_dt_interval(CAST(o_orderkey % 30 AS INT), CAST(o_orderkey % 24 AS INT)) AS createdAt""",
        "IF(o_orderstatus = 'P', NULL, CAST(floor(o_totalprice / 200) AS BIGINT)) AS duration",
    )
    return calls.selectExpr(
        "named_struct('oid', CAST(o_orderkey AS STRING)) AS _id",
        "CAST(initiator AS STRING) AS initiatorId",
        "participantIds",
        "IF(o_orderkey % 4 = 0, CAST(o_orderkey % 10 AS STRING), NULL) AS conversationId",
        "IF(o_orderkey % 2 = 0, 'video', 'audio') AS type",
        "status",
        "IF(status = 'missed', NULL, createdAt) AS startTime",
        "IF(status = 'ended', timestamp_seconds(unix_timestamp(createdAt) + duration), NULL) AS endTime",
        "duration",
        "createdAt",
    )


def message_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as bus records: JSON in ``value``, the creation time as bus ``timestamp``."""
    messages = raw_messages(spark, sf_dir).withColumn("_id", F.col("_id.oid"))
    document = F.to_json(F.struct(*schemas.STREAM_MESSAGES), JSON_OPTIONS)
    return messages.select(document.alias("value"), F.col("createdAt").alias("timestamp"))


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventType"),
        F.lit("message").alias("entityType"), (F.col("event_id") % 100).cast("string").alias("entityId"),
        F.col("user_id").cast("string").alias("userId"), F.col("props").alias("payload"), at.alias("timestamp"),
    )
    return events.select(F.to_json(F.struct(*schemas.STREAM_EVENTS), JSON_OPTIONS).alias("value"), "timestamp")
