"""One query per operator or job. Each takes (spark, sf_dir) and runs over the whole tables.

Results drop clock columns and carry dates, timestamps, lists and maps as text, so that two engines print them alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from checks.stage import stage
from palaver import schemas
from palaver.functions import arrays, calendar, columns, scores
from palaver.operators import dedup, enrich, history, incremental, layout, merge, quality, retention, running
from palaver.plans import activity, bronze, conversations, daily, engagement, features, jobs, lake, periods, silver, totals
from palaver.sources import changes, fixtures, readers, tables
from palaver.sources.fixtures import AS_OF
from palaver.sources.scratch import scratch_dir
from palaver.streaming import ingest, live, sinks

WEEK_ENDS = ("2024-01-10", "2024-01-17", "2024-01-24", "2024-01-31", "2024-02-20")
CLOCK = ("processedAt", "ingestTimestamp", "etlVersion")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame, drop: tuple[str, ...] = CLOCK) -> DataFrame:
    out = []
    for field in df.schema:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if field.name in drop:
            continue
        if isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(kind, T.MapType):
            pairs = F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
            c = F.array_join(F.array_sort(pairs), ",")
        elif isinstance(kind, T.DoubleType):
            c = F.round(c, 6)
        out.append(c.alias(field.name))
    return df.select(*out)


def _agreeing(df: DataFrame, other: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``df`` with ``agrees``: whether ``other``, the fused form that the jobs use, has the same values."""
    right = other.select(*keys, F.struct(*columns).alias("_other"))
    same = F.lit(True)
    for c in columns:
        a, b = F.col(c), F.col(f"_other.{c}")
        close = F.abs(a - b) < 1e-9 if isinstance(df.schema[c].dataType, T.DoubleType) else a == b
        same = same & F.coalesce(close, a.isNull() & b.isNull())
    return df.join(right, keys, "left").withColumn("agrees", same).drop("_other")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change table of messages: ``version`` 0 as written, 1 as edited."""
    return stage(spark, sf_dir).bronze_messages().select(
        "_id", "conversationId", "isEdited", "isForwarded", "createdAt", "updatedAt",
        F.expr("IF(updatedAt > createdAt, 1, 0) AS version"),
    )


# Sources and writes


@query
def landing_scan(spark, sf_dir):
    path = scratch_dir(spark, "landing")
    fixtures.raw_messages(spark, sf_dir).write.options(**fixtures.JSON_OPTIONS).json(path)
    raw = readers.scan_landing(spark, path, schemas.RAW_MESSAGES)
    return raw.select(
        F.col("_id.oid").alias("oid"), "conversationId", "senderId", "type", "content",
        arrays.member_field(F.col("attachments"), "url").alias("urls"),
        arrays.member_field(F.col("reactions"), "emoji").alias("emojis"), "replyTo", "isEdited", "isDeleted",
        "isForwarded", "readBy", "createdAt", "updatedAt", "expiresAt",
    )


@query
def auth_scan(spark, sf_dir):
    return readers.auth_accounts(fixtures.raw_auth(spark, sf_dir))


@query
def write_read_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "calls")
    tables.write_table(
        bronze.bronze_calls(fixtures.raw_calls(spark, sf_dir)), path, schemas.DAY_PARTITIONS, mode="overwrite"
    )
    return tables.read_table(spark, path).select(*schemas.BRONZE_CALLS)


def _merge_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Target: first versions that are not forwarded. Source: all edited versions, some of them new to the target."""
    changes = _changes(spark, sf_dir)
    return changes.filter("version = 0 AND NOT isForwarded"), changes.filter("version = 1")


@query
def merge_upsert(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    return merge.merge(target, source, ["_id"])


@query
def merge_partitions(spark, sf_dir):
    path, staging = scratch_dir(spark, "merged"), scratch_dir(spark, "staging")
    target, source = (columns.with_time_parts(d, "createdAt") for d in _merge_sides(spark, sf_dir))
    parts = list(schemas.DAY_PARTITIONS)
    tables.replace_table(target, path, parts)
    tables.upsert_partitions(spark, source, path, ["_id"], parts, staging)
    return tables.read_table(spark, path).select(
        "_id", "conversationId", "isEdited", "isForwarded", "createdAt", "updatedAt", "version"
    )


@query
def as_of_version(spark, sf_dir):
    return history.as_of_version(_changes(spark, sf_dir), ["_id"], 1)


@query
def as_of_timestamp(spark, sf_dir):
    return history.as_of_timestamp(_changes(spark, sf_dir), ["_id"], "2024-01-15 12:00:00", "updatedAt", ["version"])


@query
def compact_rewrite(spark, sf_dir):
    scattered, packed = scratch_dir(spark, "scattered"), scratch_dir(spark, "packed")
    calls = bronze.bronze_calls(fixtures.raw_calls(spark, sf_dir))
    calls.repartition(8).write.parquet(scattered)
    tables.compact_table(spark, scattered, packed)
    before, after = (
        tables.read_table(spark, p).select(F.input_file_name().alias("f")).agg(F.count_distinct("f")).scalar()
        for p in (scattered, packed)
    )
    return tables.read_table(spark, packed).select(*schemas.BRONZE_CALLS).withColumn("fewerFiles", after < before)


@query
def cluster_rewrite(spark, sf_dir):
    loose, ordered = scratch_dir(spark, "loose"), scratch_dir(spark, "ordered")
    stage(spark, sf_dir).messages().drop("content").write.parquet(loose)
    tables.cluster_table(spark, loose, ordered, ["conversationId", "senderId"], spread=["messageId"])
    rows = tables.read_table(spark, ordered)
    place = F.struct("conversationId", "senderId", "messageId")
    ranges = rows.groupBy(F.input_file_name().alias("file")).agg(F.min(place).alias("low"), F.max(place).alias("high"))
    before = F.lag("high").over(Window.orderBy("low"))  # one row for each file
    apart = ranges.select((F.col("low") > before).alias("apart")).agg(F.coalesce(F.min("apart"), F.lit(True)))
    return rows.select("messageId", "conversationId", "senderId", "messageType", "createdAt").withColumn(
        "rangesApart", apart.scalar()
    )


@query
def cluster_two_columns(spark, sf_dir):
    """Messages in 16 files; per column, whether a value's filter opens at most half of them, on the mean of all values."""
    loose, ordered = scratch_dir(spark, "loose"), scratch_dir(spark, "ordered")
    stage(spark, sf_dir).messages().drop("content").write.parquet(loose)
    keys = ["conversationId", "senderId"]
    layout.cluster_interleaved(tables.read_table(spark, loose), keys, ["messageId"], partitions=16).write.parquet(ordered)
    rows = tables.read_table(spark, ordered)
    out = rows.select("messageId", *keys, "messageType", "createdAt")
    for c in keys:
        files = rows.groupBy(F.input_file_name().alias("file")).agg(F.min(c).alias("low"), F.max(c).alias("high"))
        ranges = files.agg(F.collect_list(F.struct("low", "high"))).scalar()  # one entry for each file
        opened = F.size(F.filter(F.col("ranges"), lambda r: (r["low"] <= F.col(c)) & (F.col(c) <= r["high"])))
        share = rows.select(c).distinct().withColumn("ranges", ranges).agg(F.avg(opened / F.size("ranges")))
        out = out.withColumn(f"{c}Skips", F.coalesce(share.scalar() <= 0.5, F.lit(True)))
    return out


@query
def replace_snapshot(spark, sf_dir):
    path = scratch_dir(spark, "snapshot")
    changes = _changes(spark, sf_dir)
    tables.replace_table(changes.filter("version = 0"), path)
    tables.replace_table(changes.filter("version = 1"), path)
    return tables.read_table(spark, path)


@query
def incremental_load(spark, sf_dir):
    rows = _changes(spark, sf_dir).filter("version = 0")
    loaded = rows.filter(F.col("createdAt") < F.lit("2024-01-20").cast("timestamp"))
    now = F.lit(AS_OF).cast("timestamp")
    return incremental.incremental_load(rows, loaded, "createdAt", now)


@query
def incremental_first_load(spark, sf_dir):
    rows = _changes(spark, sf_dir).filter("version = 0")
    return incremental.incremental_load(rows, rows.filter("version > 1"), "createdAt", F.lit(AS_OF).cast("timestamp"))


@query
def retention_filter(spark, sf_dir):
    messages = stage(spark, sf_dir).bronze_messages().select("_id", "createdAt", "year", "month", "day")
    kept = retention.retain_layer(messages, "bronze", "createdAt", "2024-04-10")
    return retention.retain_partitions(kept, "2024-04-10", retention.RETENTION_DAYS["bronze"])


@query
def retention_expiry(spark, sf_dir):
    """The bronze messages after the removal of old days from the table itself."""
    path = scratch_dir(spark, "expiring")
    tables.replace_table(stage(spark, sf_dir).bronze_messages(), path, schemas.DAY_PARTITIONS)
    retention.expire_days(spark, path, "2024-04-10", retention.RETENTION_DAYS["bronze"])
    return tables.read_table(spark, path, schemas.BRONZE_MESSAGES).select("_id", "createdAt", "year", "month", "day")


# Projections and filters


@query
def bronze_projection(spark, sf_dir):
    rows = bronze.bronze_messages(fixtures.raw_messages(spark, sf_dir))
    return rows.select(
        "_id", "conversationId", "senderId", "messageType", "content", F.size("attachments").alias("attachments"),
        F.size("reactions").alias("reactions"), "replyTo", "isEdited", "isDeleted", "isForwarded", "readBy",
        "createdAt", "updatedAt", "expiresAt", "sourceSystem", "year", "month", "day",
    )


@query
def flatten_struct(spark, sf_dir):
    raw = fixtures.raw_messages(spark, sf_dir).select(
        "_id", "senderId", "updatedAt", F.try_element_at("reactions", F.lit(1)).alias("first")
    )
    return columns.flatten_struct(columns.flatten_struct(raw, "first", "reaction"), "_id")


@query
def required_fields(spark, sf_dir):
    users = fixtures.raw_users(spark, sf_dir).select(F.col("_id.oid").alias("_id"), "email", "lastSeen")
    return columns.require(users, ["_id", "email", "lastSeen"])


@query
def active_days(spark, sf_dir):
    rows = stage(spark, sf_dir).activity().filter("isActiveDay")
    return rows.select("userId", "activityDate", "messagesSent")


@query
def rolling_filter(spark, sf_dir):
    recent = columns.since(stage(spark, sf_dir).messages(), "createdAt", F.date_sub(calendar.as_date(AS_OF), 7))
    media = recent.filter(F.col("messageType").isin(*schemas.MEDIA_TYPES) & (F.col("isDeleted") == F.lit(False)))
    return media.select("messageId", "messageType", "createdAt")


@query
def fill_nulls(spark, sf_dir):
    users = fixtures.raw_users(spark, sf_dir).select(
        F.col("_id.oid").alias("_id"), "role", "isOnline", "status", "isBanned",
        F.datediff("lastSeen", "createdAt").alias("seenAfterDays"),
    )
    filled = columns.fill_defaults(users, {"role": "user", "isOnline": False, "isBanned": False, "status": ["ignored"]})
    return columns.fill_columns(filled, -1, ["seenAfterDays"])


@query
def clean_strings(spark, sf_dir):
    users = fixtures.raw_users(spark, sf_dir).select(
        F.col("_id.oid").alias("_id"), F.concat(F.lit("  "), "displayName", F.lit(" ")).alias("displayName"),
        F.concat(F.lit(" "), "role").alias("role"),
    )
    return columns.trim_strings(columns.trim_strings(users, ["displayName"], lowercase=True), ["role"])


@query
def metadata_columns(spark, sf_dir):
    users = fixtures.raw_users(spark, sf_dir).select(F.col("_id.oid").alias("_id"))
    stamped = columns.with_processing(columns.with_ingestion(users, "mongodb+mysql"))
    return stamped.withColumn("version", F.col("etlVersion")).withColumn(
        "stamped", F.col("processedAt").isNotNull() & F.col("ingestTimestamp").isNotNull()
    )


@query
def time_partitions(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return columns.with_time_parts(events, "ts")


# Joins


@query
def users_auth_left(spark, sf_dir):
    rows = bronze.bronze_users(fixtures.raw_users(spark, sf_dir), stage(spark, sf_dir).accounts())
    return rows.select("_id", "email", "emailVerified", "twoFactorEnabled", "lastLoginAt", "loginCount")


@query
def sender_lookup(spark, sf_dir):
    messages = stage(spark, sf_dir).bronze_messages().select("_id", "senderId", "updatedAt")
    names = stage(spark, sf_dir).bronze_users().select("_id", F.col("displayName").alias("senderName"))
    return enrich.lookup(messages, "senderId", names.withColumnRenamed("_id", "userId"), "userId")


@query
def activity_spine(spark, sf_dir):
    """The five aggregates of user activity joined one by one, against the stacked form of ``user_activity``."""
    messages, calls = stage(spark, sf_dir).messages(), stage(spark, sf_dir).calls()
    rows = activity.message_activity(messages)
    for side in (
        activity.reactions_by_day(messages), activity.calls_initiated(calls), activity.calls_received(calls),
        activity.first_touch(messages),
    ):
        rows = rows.join(side, activity.USER_DAY, "left")
    filled = columns.fill_columns(rows, 0, [
        "reactionsGiven", "callsInitiated", "totalCallDurationSeconds", "callsReceived", "newConversationsStarted",
    ])
    return _agreeing(filled, activity.user_activity(messages, calls), activity.USER_DAY, [
        "messagesSent", "mediaShared", "reactionsReceived", "conversationsActive", "reactionsGiven", "callsInitiated",
        "callsReceived", "newConversationsStarted",
    ])


@query
def user_spine(spark, sf_dir):
    users = stage(spark, sf_dir).users().select("userId")
    totals = engagement.lifetime_totals(stage(spark, sf_dir).activity())
    joined = users.join(totals, "userId", "left")
    pairs = engagement.contact_pairs(stage(spark, sf_dir).messages())
    joined = joined.join(engagement.network_size(pairs), "userId", "left")
    return joined.select("userId", "totalMessagesSent", "lastActiveDate", "conversationsParticipating")


@query
def date_spine(spark, sf_dir):
    s = stage(spark, sf_dir)
    rows = daily.active_users_per_day(s.activity())
    for side in (daily.new_per_day(s.users(), "newUsers"), daily.call_metrics(s.calls())):
        rows = rows.join(side, "metricDate", "left")
    return rows.select("metricDate", "activeUsers", "newUsers", "totalCalls")


@query
def group_messages(spark, sf_dir):
    s = stage(spark, sf_dir)
    groups = s.conversations().filter(F.col("conversationType") == "group")
    messages = s.messages().select("messageId", "senderId", "conversationId")
    return enrich.restrict_to(messages, "conversationId", groups, "_id")


# Aggregations


@query
def message_activity(spark, sf_dir):
    return activity.message_activity(stage(spark, sf_dir).messages())


@query
def conversation_day_counts(spark, sf_dir):
    return activity.conversation_day_counts(stage(spark, sf_dir).messages())


@query
def reactions_by_day(spark, sf_dir):
    return activity.reactions_by_day(stage(spark, sf_dir).messages())


@query
def reactions_given_true(spark, sf_dir):
    versions = stage(spark, sf_dir).bronze_messages()
    return activity.reactions_given_true(dedup.deduplicate(versions, ["_id"], "updatedAt"))


@query
def calls_initiated(spark, sf_dir):
    return activity.calls_initiated(stage(spark, sf_dir).calls())


@query
def calls_received(spark, sf_dir):
    return activity.calls_received(stage(spark, sf_dir).calls())


@query
def first_touch(spark, sf_dir):
    return activity.first_touch(stage(spark, sf_dir).messages())


@query
def new_users_daily(spark, sf_dir):
    return daily.new_per_day(stage(spark, sf_dir).users(), "newUsers")


@query
def new_conversations_daily(spark, sf_dir):
    return daily.new_per_day(stage(spark, sf_dir).conversations(), "newConversations")


@query
def distinct_user_dates(spark, sf_dir):
    return daily.distinct_user_dates(stage(spark, sf_dir).users())


@query
def dau(spark, sf_dir):
    return daily.active_users_per_day(stage(spark, sf_dir).activity())


@query
def message_mix(spark, sf_dir):
    messages = stage(spark, sf_dir).messages()
    return _agreeing(daily.message_mix(messages), daily.message_metrics(messages), ["metricDate"], [
        "totalMessages", "textMessages", "mediaMessages", "totalReactions",
    ])


@query
def peak_hour(spark, sf_dir):
    messages = stage(spark, sf_dir).messages()
    return _agreeing(daily.peak_hour_per_day(messages), daily.message_metrics(messages), ["metricDate"], ["peakHour"])


@query
def call_metrics(spark, sf_dir):
    return daily.call_metrics(stage(spark, sf_dir).calls())


@query
def active_conversations(spark, sf_dir):
    return daily.active_conversations_per_day(stage(spark, sf_dir).messages())


@query
def activity_7_30(spark, sf_dir):
    return engagement.rolling_activity(stage(spark, sf_dir).activity(), AS_OF)


@query
def lifetime_totals(spark, sf_dir):
    return engagement.lifetime_totals(stage(spark, sf_dir).activity())


@query
def user_totals_carried(spark, sf_dir):
    """Totals as of the tenth, carried to the twentieth and then to the end of the month.

    Each state sees the activity of its own time; in the last step all days from the twelfth on count as changed, and what
    they held before is half of it.
    """
    rows = stage(spark, sf_dir).activity()
    day = F.col("activityDate")
    partial = rows.filter(day <= F.lit("2024-01-20")).filter("activityDate < DATE '2024-01-12' OR messagesSent % 2 = 0")
    state = tables.staged(totals.user_totals(rows.filter(day <= F.lit("2024-01-10")), "2024-01-10"), "totals")
    eleventh, twelfth = dt.date(2024, 1, 11), dt.date(2024, 1, 12)
    state = totals.carry_totals(state, rows.filter("false"), partial, eleventh, "2024-01-20")
    old_days = partial.filter(day >= F.lit(twelfth))
    return totals.windows_and_lifetime(totals.carry_totals(state, old_days, rows, twelfth, AS_OF))


@query
def network_size(spark, sf_dir):
    return engagement.network_size(engagement.contact_pairs(stage(spark, sf_dir).messages()))


@query
def groups_per_user(spark, sf_dir):
    pairs = engagement.contact_pairs(stage(spark, sf_dir).messages())
    return engagement.groups_per_user(pairs, stage(spark, sf_dir).conversations())


def _like_features(spark, sf_dir, part: DataFrame, columns: list[str]) -> DataFrame:
    """``part`` against the feature vectors of the same users; users outside the spine agree with nothing and are left."""
    s = stage(spark, sf_dir)
    spine = s.activity().select("userId").union(s.messages().select(F.col("senderId"))).distinct()
    return _agreeing(part, features.user_features(s.activity(), spine, s.messages(), AS_OF), ["userId"], columns)


@query
def feature_windows(spark, sf_dir):
    part = features.feature_windows(stage(spark, sf_dir).activity(), AS_OF)
    return _like_features(spark, sf_dir, part, [
        "msgSentLast1d", "msgSentLast7d", "msgSentLast30d", "activeDaysLast7d", "activeDaysLast30d",
        "avgSessionDurationMinutes",
    ])


@query
def social_features(spark, sf_dir):
    part = features.social_features(stage(spark, sf_dir).messages(), AS_OF)
    return _like_features(spark, sf_dir, part, ["uniqueContacts", "groupCount", "avgGroupSize"])


@query
def group_features(spark, sf_dir):
    pairs = engagement.contact_pairs(stage(spark, sf_dir).messages())
    return features.group_features(pairs, stage(spark, sf_dir).conversations())


@query
def temporal_features(spark, sf_dir):
    part = features.temporal_features(stage(spark, sf_dir).messages(), AS_OF)
    return _like_features(spark, sf_dir, part, ["preferredHour", "weekdayActivityRatio"])


@query
def velocity(spark, sf_dir):
    part = features.velocity(stage(spark, sf_dir).activity(), AS_OF)
    return _like_features(spark, sf_dir, part, ["messageVelocity7d", "engagementTrend"])


@query
def churn_label(spark, sf_dir):
    part = features.churn_label(stage(spark, sf_dir).activity(), AS_OF)
    return _like_features(spark, sf_dir, part, ["willChurnNext7d"])


@query
def high_water_mark(spark, sf_dir):
    """Of edits over all rows, of creations from the newest directory alone."""
    rows = stage(spark, sf_dir).bronze_messages()
    created = incremental.high_water_mark(rows, "createdAt", schemas.DAY_PARTITIONS).scalar()
    return incremental.high_water_mark(rows, "updatedAt").withColumn("newestCreated", created)


@query
def row_counts(spark, sf_dir):
    s = stage(spark, sf_dir)
    named = {"messages": s.bronze_messages(), "users": s.bronze_users(), "calls": s.calls()}
    observed = [(n, tables.write_table(df, scratch_dir(spark, "counted"))) for n, df in named.items()]
    return spark.createDataFrame(observed, "table string, rows bigint")


# Windows


@query
def dedup_latest(spark, sf_dir):
    return dedup.deduplicate(_changes(spark, sf_dir), ["_id"], "updatedAt", tie_break=["version"])


@query
def dedup_earliest(spark, sf_dir):
    rows = stage(spark, sf_dir).bronze_messages().select("_id", "senderId", "conversationId", "createdAt", "updatedAt")
    return dedup.deduplicate(rows, ["senderId", "conversationId"], "updatedAt", descending=False, tie_break=["_id"])


@query
def running_totals(spark, sf_dir):
    per_day = daily.new_per_day(stage(spark, sf_dir).users(), "newUsers")
    return running.running_totals(per_day, "metricDate", {"totalUsers": "newUsers"})


# Scalar expressions


@query
def date_parts(spark, sf_dir):
    at = F.col("l_shipdate").cast("timestamp")
    lines = fixtures.table(spark, sf_dir, "lineitem").withColumns(columns.time_parts(at))
    return lines.groupBy("year", "month", "day", "hour", "dayOfWeek", "isWeekend").agg(F.count(F.lit(1)).alias("lines"))


@query
def date_math(spark, sf_dir):
    users = fixtures.raw_users(spark, sf_dir)
    seen, made = F.col("lastSeen"), F.col("createdAt")
    return users.select(
        F.col("_id.oid").alias("userId"), calendar.days_between(made, seen).alias("daysBetween"),
        calendar.days_since(made, AS_OF).alias("daysSince"), F.date_sub(F.to_date(made), 7).alias("weekBefore"),
        calendar.hours_before(made, 36).alias("hoursBefore"),
    )


@query
def string_lengths(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    text = F.col("text")
    return docs.select(
        "doc_id", F.length(text).alias("chars"), F.length(F.trim(text)).alias("trimmedChars"),
        (text.isNotNull() & (text != "")).alias("hasText"), (F.lower("lang") == "en").alias("isEnglish"),
    )


@query
def array_sizes(spark, sf_dir):
    raw = fixtures.raw_messages(spark, sf_dir)
    safe = arrays.or_empty(F.col("attachments"), schemas.ATTACHMENTS)
    return raw.select(
        F.col("_id.oid").alias("_id"), "updatedAt", arrays.size_or_zero(F.col("attachments")).alias("attachments"),
        arrays.size_or_zero(F.col("reactions")).alias("reactions"), F.size(safe).alias("attachmentsOrEmpty"),
    )


@query
def attachment_types(spark, sf_dir):
    rows = stage(spark, sf_dir).bronze_messages()
    return rows.select("_id", "updatedAt", arrays.member_field(F.col("attachments"), "type").alias("types"))


@query
def unique_reactors(spark, sf_dir):
    rows = stage(spark, sf_dir).bronze_messages()
    return rows.select("_id", "updatedAt", arrays.distinct_members(F.col("reactions"), "userId").alias("reactors"))


@query
def json_parse(spark, sf_dir):
    """Event payloads against a schema with one absent field; every seventh document is cut short and so malformed."""
    events = fixtures.table(spark, sf_dir, "events")
    cut = F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    return events.select("event_id", F.from_json(cut, "k int, absent string").alias("data")).select("event_id", "data.*")


def _engagement_inputs(spark, sf_dir):
    return engagement.rolling_activity(stage(spark, sf_dir).activity(), AS_OF).fillna(0)


@query
def engagement_score(spark, sf_dir):
    rows = _engagement_inputs(spark, sf_dir)
    parts = [F.col("messagesSentLast30"), F.col("reactionsGivenLast30"), F.col("callsInitiatedLast30")]
    days = F.col("activeDaysLast30")
    return rows.select(
        "userId", scores.engagement_score(*parts, days).alias("score"),
        scores.engagement_score(*parts, days, cap=True).alias("capped"),
    )


@query
def activity_trend(spark, sf_dir):
    week, month = F.col("messagesSentLast7"), F.col("messagesSentLast30")
    return _engagement_inputs(spark, sf_dir).select("userId", scores.activity_trend(week, month - week).alias("trend"))


@query
def churn_risk(spark, sf_dir):
    rows = engagement.lifetime_totals(stage(spark, sf_dir).activity()).select("userId", "lastActiveDate")
    joined = rows.join(_engagement_inputs(spark, sf_dir), "userId", "left").fillna(0)
    idle = calendar.days_since(F.col("lastActiveDate"), AS_OF)
    risk = scores.churn_risk(F.col("activeDaysLast7"), F.col("activeDaysLast30"), idle)
    return joined.select("userId", risk.alias("risk"))


@query
def user_segment(spark, sf_dir):
    segment = scores.user_segment(F.col("activeDaysLast30"), F.col("messagesSentLast30"))
    return _engagement_inputs(spark, sf_dir).select("userId", segment.alias("segment"))


@query
def conversation_health(spark, sf_dir):
    """Messages of the last week and days since the last message, as of the end of every week of the month."""
    s = stage(spark, sf_dir)
    days = s.messages().select(F.col("conversationId").alias("_id"), F.to_date("createdAt").alias("d"))
    weeks = F.explode(F.array(*[F.lit(w).cast("date") for w in WEEK_ENDS])).alias("weekEnd")
    counted = days.select("_id", "d", weeks).filter("d <= weekEnd").groupBy("_id", "weekEnd").agg(
        F.count_if(F.datediff("weekEnd", "d") <= 7).alias("recent"), F.datediff("weekEnd", F.max("d")).alias("idle")
    )
    rows = s.conversations().select("_id", weeks).join(counted, ["_id", "weekEnd"], "left")
    health = scores.conversation_health(F.coalesce("recent", F.lit(0)), F.coalesce("idle", F.lit(999)))
    return rows.select("_id", "weekEnd", health.alias("health"))


@query
def duration_category(spark, sf_dir):
    return stage(spark, sf_dir).calls().select(
        "_id", scores.duration_category(F.col("duration")).alias("category")
    )


@query
def categorize(spark, sf_dir):
    buckets = [(0.0, 1000.0, "low"), (1000.0, 5000.0, "mid"), (4000.0, 9000.0, "high")]
    customers = fixtures.table(spark, sf_dir, "customer")
    return customers.select("c_custkey", scores.categorize(F.col("c_acctbal"), buckets).alias("bucket"))


# Streams


class _Bus:
    """A folder that receives bus records in two deliveries, the earlier half of the month first."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.spark, self.stage, self.name = spark, stage(spark, sf_dir), name
        self.folder = scratch_dir(spark, "bus")

    def deliver(self, first_half: bool) -> DataFrame:
        tables.write_table(self.stage.bus_values(self.name, first_half), self.folder)
        return readers.scan_value_files(self.spark, self.folder)


def _two_runs(spark, sf_dir, name: str, start: Callable[[DataFrame, str, str], StreamingQuery]) -> str:
    """Run a stream to its end after each delivery, on one checkpoint; returns the output folder."""
    bus, out, mark = _Bus(spark, sf_dir, name), scratch_dir(spark, "stream"), scratch_dir(spark, "marks")
    for first_half in (True, False):
        sinks.await_all([start(bus.deliver(first_half), out, mark)])
    return out


def _by_day(parse):
    return lambda values, out, mark: sinks.append_to_table(
        parse(values), out, mark, schemas.DAY_PARTITIONS, every=None
    )


@query
def stream_messages(spark, sf_dir):
    out = _two_runs(spark, sf_dir, "messages", _by_day(ingest.message_stream))
    return tables.read_table(spark, out, schemas.BRONZE_MESSAGES).select(
        "_id", "conversationId", "senderId", "messageType", "content",
        arrays.member_field(F.col("attachments"), "url").alias("urls"), F.size("reactions").alias("reactions"),
        "replyTo", "isEdited", "isDeleted", "isForwarded", "createdAt", "updatedAt", "sourceSystem", "year", "month",
        "day",
    )


@query
def stream_events(spark, sf_dir):
    out = _two_runs(spark, sf_dir, "events", _by_day(ingest.event_stream))
    return tables.read_table(spark, out, schemas.BRONZE_EVENTS)


@query
def stream_live_metrics(spark, sf_dir):
    out = _two_runs(spark, sf_dir, "messages", lambda values, out, mark: sinks.add_changes(
        live.live_members(values), out, mark, "update", None
    ))
    return live.live_metrics_exact(changes.read_current(spark, out, live.MEMBERS))


@query
def stream_live_metrics_final(spark, sf_dir):
    """The windows that the watermark has closed at the end of the stream."""
    out = _two_runs(spark, sf_dir, "messages", lambda values, out, mark: sinks.append_to_table(
        live.live_metrics_final(values), out, mark, live.WINDOW_PARTITIONS, every=None
    ))
    return tables.read_table(spark, out).drop(*live.WINDOW_PARTITIONS)


@query
def stream_live_metrics_approx(spark, sf_dir):
    """Sketched counts against the exact ones: within three deviations (5% each) and one."""
    out = _two_runs(spark, sf_dir, "messages", lambda values, out, mark: sinks.merge_updates(
        live.live_metrics(values), out, mark, ["windowStart"], live.WINDOW_PARTITIONS, every=None
    ))
    rows = tables.read_table(spark, out).select(
        "windowStart", "windowEnd", "messageCount", "activeUsers", "activeConversations", "avgMessageLength"
    )
    window = F.window("createdAt", live.WINDOW)
    exact = fixtures.raw_messages(spark, sf_dir).groupBy(window).agg(
        F.count_distinct("senderId").alias("users"), F.count_distinct("conversationId").alias("conversations")
    ).select(F.col("window.start").alias("windowStart"), "users", "conversations")

    def close(sketch: str, true: str) -> F.Column:
        return F.abs(F.col(sketch) - F.col(true)) <= 0.15 * F.col(true) + 1

    return rows.join(exact, "windowStart", "left").select(
        "windowStart", "windowEnd", "messageCount", close("activeUsers", "users").alias("usersClose"),
        close("activeConversations", "conversations").alias("conversationsClose"), "avgMessageLength",
    )


@query
def stream_and_batch_messages(spark, sf_dir):
    """One bronze table: the first half of the month by the batch upsert, the second by the stream, restarted once."""
    spec, s = lake.TABLES["bronze/messages"], stage(spark, sf_dir)
    path, mark = scratch_dir(spark, "bronze"), scratch_dir(spark, "marks")
    early = s.bronze_messages().filter("createdAt < DATE '2024-01-16'")
    newest = dedup.deduplicate(early, spec.keys, spec.version, tie_break=spec.tie_break)
    tables.upsert_partitions(spark, newest, path, spec.keys, spec.partition_by)
    bus = _Bus(spark, sf_dir, "messages")
    for deliver in (True, False):
        values = bus.deliver(False) if deliver else readers.scan_value_files(spark, bus.folder)
        sinks.await_all([sinks.add_changes(ingest.message_stream(values), path, mark, every=None)])
        if deliver:  # a batch job runs in between
            changes.fold_changes(spark, path, spec.keyed)
    return changes.read_current(spark, path, spec.keyed).select(
        "_id", "senderId", "isEdited", "sourceSystem", "createdAt", "updatedAt"
    )


@query
def stream_dedup(spark, sf_dir):
    def once(values, out, mark):
        stream = ingest.drop_repeats(ingest.message_stream(values), ["_id"])
        return sinks.append_to_table(stream, out, mark, every=None)

    out = _two_runs(spark, sf_dir, "messages", once)
    return tables.read_table(spark, out).select("_id", "conversationId", "senderId", "createdAt")


@query
def stream_two_queries(spark, sf_dir):
    """Message and event ingest side by side; rows per target table and day."""
    started, outs = [], {}
    for name, parse in (("messages", ingest.message_stream), ("events", ingest.event_stream)):
        bus = _Bus(spark, sf_dir, name)
        bus.deliver(True)
        outs[name] = scratch_dir(spark, "stream")
        started.append(_by_day(parse)(bus.deliver(False), outs[name], scratch_dir(spark, "marks")))
    sinks.await_all(started)
    per_day = [
        tables.read_table(spark, path).groupBy(F.lit(name).alias("table"), "year", "month", "day")
        .agg(F.count(F.lit(1)).alias("rows"))
        for name, path in outs.items()
    ]
    return per_day[0].unionByName(per_day[1])


# Jobs


@query
def bronze_messages(spark, sf_dir):
    rows = bronze.bronze_messages(fixtures.raw_messages(spark, sf_dir))
    return rows.withColumns({
        "attachments": arrays.member_field(F.col("attachments"), "filename"),
        "reactions": F.transform("reactions", lambda r: F.concat_ws(":", r["userId"], r["emoji"])),
    })


@query
def bronze_users(spark, sf_dir):
    return bronze.bronze_users(fixtures.raw_users(spark, sf_dir), stage(spark, sf_dir).accounts())


@query
def bronze_conversations(spark, sf_dir):
    return bronze.bronze_conversations(fixtures.raw_conversations(spark, sf_dir))


@query
def bronze_calls(spark, sf_dir):
    return bronze.bronze_calls(fixtures.raw_calls(spark, sf_dir))


@query
def silver_messages(spark, sf_dir):
    return silver.silver_messages(stage(spark, sf_dir).bronze_messages(), stage(spark, sf_dir).bronze_users())


@query
def silver_users(spark, sf_dir):
    return silver.silver_users(stage(spark, sf_dir).bronze_users(), AS_OF)


@query
def user_activity(spark, sf_dir):
    return activity.user_activity(stage(spark, sf_dir).messages(), stage(spark, sf_dir).calls())


@query
def user_activity_full(spark, sf_dir):
    return activity.user_activity(stage(spark, sf_dir).messages(), stage(spark, sf_dir).calls(), spine="full")


def _daily(spark, sf_dir, spine: str) -> DataFrame:
    s = stage(spark, sf_dir)
    return daily.daily_metrics(s.messages(), s.users(), s.activity(), s.calls(), s.conversations(), spine)


@query
def daily_metrics_carried(spark, sf_dir):
    """Daily metrics of kept day states: those of the first half of the month, then those of the second merged in."""
    s, path = stage(spark, sf_dir), scratch_dir(spark, "states")
    for half in ("< DATE '2024-01-16'", ">= DATE '2024-01-16'"):
        part = daily.day_states(
            s.messages().filter(f"createdAt {half}"), s.activity().filter(f"activityDate {half}"),
            s.calls().filter(f"createdAt {half}"),
        )
        tables.upsert_partitions(spark, part, path, ["metricDate"], schemas.MONTH_PARTITIONS)
    return daily.daily_from_states(tables.read_table(spark, path, schemas.DAY_STATES), s.users(), s.conversations(), "full")


@query
def daily_metrics(spark, sf_dir):
    return _daily(spark, sf_dir, "dau")


@query
def daily_metrics_full(spark, sf_dir):
    return _daily(spark, sf_dir, "full")


@query
def user_engagement(spark, sf_dir):
    s = stage(spark, sf_dir)
    return engagement.user_engagement(s.users(), s.activity(), s.messages(), AS_OF)


@query
def user_engagement_groups(spark, sf_dir):
    s = stage(spark, sf_dir)
    rows = engagement.user_engagement(s.users(), s.activity(), s.messages(), AS_OF, s.conversations(), cap_score=True)
    return rows.select("userId", "groupsParticipating", "engagementScore")


@query
def user_features(spark, sf_dir):
    s = stage(spark, sf_dir)
    return features.user_features(s.activity(), s.users(), s.messages(), AS_OF)


def raw_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "messages": fixtures.raw_messages(spark, sf_dir), "users": fixtures.raw_users(spark, sf_dir),
        "auth": fixtures.raw_auth(spark, sf_dir), "conversations": fixtures.raw_conversations(spark, sf_dir),
        "calls": fixtures.raw_calls(spark, sf_dir),
    }


# Key and three measures of each table whose content a whole run is compared by.
CONTENT = {
    "silver/messages": ("messageId", "contentLength", "reactionCount", "isEdited"),
    "gold/metrics/daily": ("metricDate", "totalMessages", "activeUsers", "avgMessagesPerUser"),
    "gold/metrics/weekly": ("weekStartDate", "weeklyActiveUsers", "returningUsers", "engagementScore"),
    "gold/metrics/monthly": ("yearMonth", "monthlyActiveUsers", "avgDailyMessages", "peakDayOfWeek"),
    "gold/analytics/user_engagement": (
        "userId", "totalMessagesSent", "conversationsParticipating", "engagementScore"
    ),
    "gold/analytics/conversations": ("conversationId", "totalMessages", "avgMessagesPerDay", "peakActivityHour"),
    "gold/ml_features": ("userId", "msgSentLast30d", "uniqueContacts", "messageVelocity7d"),
}


def _content(run: lake.Lake) -> DataFrame:
    out = None
    for name, (key, *measures) in CONTENT.items():
        values = [F.col(m).cast("double").alias(f"v{i}") for i, m in enumerate(measures)]
        part = run.table(name).select(F.lit(name).alias("table"), F.col(key).cast("string").alias("key"), *values)
        out = part if out is None else out.unionByName(part)
    return out


def updated_lake(spark: SparkSession, sf_dir: str) -> lake.Lake:
    """A lake of the first half of the month, then updated in place by the second half and by late edits of the first."""
    raw, root = raw_inputs(spark, sf_dir), scratch_dir(spark, "lake")
    edited, late = F.coalesce("isEdited", F.lit(False)), F.col("createdAt") >= F.lit("2024-01-16").cast("date")
    lake.run_lake(spark, {
        **raw, "messages": raw["messages"].filter(~edited & ~late), "calls": raw["calls"].filter(~late),
    }, root, AS_OF)
    return lake.run_lake(spark, {
        **raw, "messages": raw["messages"].filter(edited | late), "calls": raw["calls"].filter(late),
    }, root, AS_OF, changed_since="2024-01-16")


@query
def medallion_run(spark, sf_dir):
    return _content(lake.run_lake(spark, raw_inputs(spark, sf_dir), scratch_dir(spark, "lake"), AS_OF, cluster=True))


@query
def single_jobs(spark, sf_dir):
    """The tables of a whole run, each made by a call of its own."""
    root, raw = scratch_dir(spark, "lake"), raw_inputs(spark, sf_dir)
    for name in jobs.JOBS:
        run = jobs.run_jobs(spark, root, [name], AS_OF, raw)
    return _content(run)


@query
def merge_existing_lake(spark, sf_dir):
    return _content(updated_lake(spark, sf_dir))


@query
def user_activity_incremental(spark, sf_dir):
    return updated_lake(spark, sf_dir).table("silver/user_activity")


# Declared outputs


@query
def silver_conversations(spark, sf_dir):
    return silver.silver_conversations(stage(spark, sf_dir).conversations(), AS_OF)


@query
def silver_calls(spark, sf_dir):
    return silver.silver_calls(stage(spark, sf_dir).calls())


@query
def weekly_metrics(spark, sf_dir):
    return periods.weekly_metrics(_daily(spark, sf_dir, "full"), stage(spark, sf_dir).activity())


@query
def monthly_metrics(spark, sf_dir):
    s = stage(spark, sf_dir)
    return periods.monthly_metrics(_daily(spark, sf_dir, "full"), s.activity(), daily.message_types_per_day(s.messages()))


@query
def conversation_analytics(spark, sf_dir):
    s = stage(spark, sf_dir)
    latest = silver.silver_conversations(s.conversations(), AS_OF)
    return conversations.conversation_analytics(latest, s.messages(), AS_OF)


@query
def quality_report(spark, sf_dir):
    s = stage(spark, sf_dir)
    messages = quality.quality_report(
        s.bronze_messages(), "bronze.messages", ["_id"], ["content", "replyTo"],
        {"messageType": ("text", "image")}, ["createdAt"], "2024-01-20",
    )
    users = quality.quality_report(
        s.bronze_users(), "bronze.users", ["_id"], ["email"], {"role": ("BUILDING", "user")}, ["createdAt"], AS_OF
    )
    calls = quality.quality_report(
        s.calls(), "bronze.calls", ["_id"], ["duration"],
        {"status": schemas.CALL_STATUSES, "callType": schemas.CALL_TYPES}, ["createdAt"], AS_OF,
    )
    return messages.unionByName(users).unionByName(calls)


