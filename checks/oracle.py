"""DuckDB SQL that each registered query is compared with.

Written from the rules of the inputs and the definition of each operator, in joins and plain aggregates; it shares no
code with the library. ``WITH_`` collects the common table expressions a query may use.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-31'"
TS = "'%Y-%m-%d %H:%M:%S.%f'"


def ts(expr: str, name: str) -> str:
    return f"strftime({expr}, {TS}) AS {name}"


WITH_ = f"""
WITH n_conv AS (SELECT count(DISTINCT conv_id) AS n FROM conversations),
n_users AS (SELECT count(DISTINCT user_id) AS n FROM events),
kept AS (
  SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    ts + to_days(CAST(CASE user_id % 10 WHEN 1 THEN n % 20 - n WHEN 6 THEN n % 20 - n WHEN 2 THEN n % 12 - n
      WHEN 7 THEN n % 3 - n WHEN 3 THEN 21 + n % 10 - n WHEN 8 THEN 21 + n % 10 - n WHEN 4 THEN 16 + n % 15 - n
      WHEN 9 THEN 16 + n % 15 - n ELSE 0 END AS INTEGER)) AS ts
  FROM (SELECT *, CAST(ts AS DATE) - DATE '2024-01-01' AS n FROM events)
),
copies AS (
  SELECT *, CAST(event_id AS VARCHAR) AS id, ts AS at FROM kept
  UNION ALL
  SELECT *, event_id || '-2' AS id, ts + INTERVAL 30 MINUTE AS at FROM kept WHERE user_id % 5 = 0
),
msg0 AS (
  SELECT c.event_id, c.id AS _id, CAST((c.user_id * 7 + c.k) % n.n AS VARCHAR) AS conversationId,
    CAST(c.user_id AS VARCHAR) AS senderId,
    CASE c.event_type WHEN 'click' THEN 'text' WHEN 'view' THEN 'image' WHEN 'purchase' THEN 'video'
      WHEN 'signup' THEN 'file' WHEN 'error' THEN 'system' END AS messageType,
    CASE WHEN c.k % 10 <> 0 THEN t.text END AS content,
    CASE WHEN c.event_type = 'view' THEN ['image'] WHEN c.event_type = 'purchase' THEN ['video', 'image']
      WHEN c.event_type = 'error' THEN NULL ELSE CAST([] AS VARCHAR[]) END AS kinds,
    [CAST((c.user_id + i) % 3 AS VARCHAR) FOR i IN range(c.k % 4)] AS reactors,
    [CAST(c.user_id + i + 1 AS VARCHAR) FOR i IN range(c.k % 3)] AS readBy,
    CASE WHEN c.k % 5 = 0 THEN CAST(c.event_id - 1 AS VARCHAR) END AS replyTo,
    CAST(NULL AS BOOLEAN) AS isEdited, c.k = 99 AS isDeleted,
    CASE WHEN c.k % 13 = 0 THEN true END AS isForwarded,
    c.at AS createdAt, c.at AS updatedAt,
    CASE WHEN c.k % 20 = 0 THEN c.at + INTERVAL 1 DAY END AS expiresAt
  FROM copies c CROSS JOIN n_conv n
  LEFT JOIN (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS slot,
      count(*) OVER (PARTITION BY conv_id) AS turns, text FROM conversations) t
    ON t.conv_id = (c.user_id * 7 + c.k) % n.n AND t.slot = c.event_id % t.turns
),
raw_messages AS (
  SELECT *, 0 AS version FROM msg0
  UNION ALL
  SELECT * REPLACE (true AS isEdited, updatedAt + INTERVAL 1 HOUR AS updatedAt), 1 AS version
  FROM msg0 WHERE event_id % 10 = 0
),
raw_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS _id, '+1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phoneNumber,
    CASE WHEN c_custkey % 50 <> 0 THEN lower(c_name) || '@example.com' END AS email, lower(c_name) AS username,
    c_name AS displayName,
    CASE c_custkey % 3 WHEN 1 THEN '' WHEN 2 THEN 'https://a.example.com/' || c_custkey END AS avatar,
    CASE c_custkey % 4 WHEN 0 THEN 'bio of ' || c_name WHEN 1 THEN '' END AS bio,
    CASE WHEN c_custkey % 6 = 0 THEN 'busy' END AS status,
    CASE WHEN c_custkey % 7 <> 0 THEN CAST(DATE '2023-12-15' + CAST(c_custkey % 45 + c_custkey % 10 AS INTEGER)
      AS TIMESTAMP) END AS lastSeen,
    CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 5 = 1 END AS isOnline,
    CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS role,
    CASE WHEN c_custkey % 9 = 0 THEN true END AS isBanned, c_custkey % 2 = 0 AS isVerified,
    CAST(DATE '2023-12-15' + CAST(c_custkey % 45 AS INTEGER) AS TIMESTAMP) AS createdAt
  FROM customer
),
raw_auth AS (
  SELECT c_custkey * 2 + o AS id,
    CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'work-' END || lower(c_name) || '@example.com' AS email, c_custkey % 4 = 0 AS email_verified,
    c_custkey % 6 = 0 AS two_factor_enabled,
    CAST(DATE '2024-01-01' + CAST(c_custkey % 28 - o AS INTEGER) AS TIMESTAMP) AS last_login_at,
    CAST(floor(abs(c_acctbal)) AS BIGINT) AS login_count, TIMESTAMP '2023-12-01' AS created_at
  FROM customer CROSS JOIN (VALUES (0), (1)) v(o)
  WHERE o = 0 OR c_custkey % 10 = 0
),
b_users AS (
  SELECT u._id, u.phoneNumber, u.email, u.username, u.displayName, u.avatar, u.bio, u.status, u.lastSeen,
    coalesce(u.isOnline, false) AS isOnline, coalesce(u.role, 'user') AS role,
    coalesce(u.isBanned, false) AS isBanned, u.isVerified, a.email_verified AS emailVerified,
    a.two_factor_enabled AS twoFactorEnabled, a.last_login_at AS lastLoginAt, a.login_count AS loginCount,
    u.createdAt, u.createdAt AS updatedAt
  FROM raw_users u
  LEFT JOIN (SELECT DISTINCT ON (email) * FROM raw_auth ORDER BY email, last_login_at DESC, id DESC) a
    ON a.email = u.email
),
turns AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1),
last_message AS (SELECT conversationId, max(createdAt) AS at FROM msg0 GROUP BY 1),
b_conversations AS (
  SELECT CAST(t.conv_id AS VARCHAR) AS _id, CASE WHEN t.n > 4 THEN 'group' ELSE 'single' END AS conversationType,
    CASE WHEN t.n > 4 THEN 'group ' || t.conv_id END AS name,
    CASE t.conv_id % 3 WHEN 1 THEN '' WHEN 2 THEN 'https://c.example.com/' || t.conv_id END AS avatar,
    [CAST(t.conv_id + i AS VARCHAR) FOR i IN range(CASE WHEN t.n > 4 THEN 3 + t.conv_id % 8 ELSE 2 END)]
      AS participants,
    CASE WHEN t.conv_id % 4 <> 0 THEN [CAST(t.conv_id AS VARCHAR)] ELSE CAST([] AS VARCHAR[]) END AS admins,
    CASE WHEN t.conv_id % 5 <> 0 THEN 'last-' || t.conv_id END AS lastMessageId,
    CASE WHEN t.conv_id % 5 <> 0 THEN l.at END AS lastMessageAt,
    t.conv_id % 6 = 0 AS isArchived, false AS isLocked, CAST(t.conv_id AS VARCHAR) AS createdBy,
    CAST(DATE '2024-01-01' + CAST(t.conv_id % 30 AS INTEGER) AS TIMESTAMP) AS createdAt
  FROM turns t LEFT JOIN last_message l ON l.conversationId = CAST(t.conv_id AS VARCHAR)
),
people AS (
  SELECT l_orderkey, list_sort(list_distinct(list(CAST(l_suppkey AS VARCHAR)))) AS ids
  FROM lineitem GROUP BY 1
),
b_calls AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS _id, CAST(o_custkey % n.n AS VARCHAR) AS initiatorId,
    coalesce(p.ids, CAST([] AS VARCHAR[])) AS participantIds,
    CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 10 AS VARCHAR) END AS conversationId,
    CASE WHEN o_orderkey % 2 = 0 THEN 'video' ELSE 'audio' END AS callType,
    CASE o_orderstatus WHEN 'F' THEN 'ended' WHEN 'O' THEN 'ongoing' WHEN 'P' THEN 'missed' END AS status,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 200) AS BIGINT) END AS duration,
    TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INTEGER)) + to_hours(o_orderkey % 24) AS createdAt
  FROM orders CROSS JOIN n_users n LEFT JOIN people p ON p.l_orderkey = o_orderkey
),
latest AS (
  SELECT * FROM raw_messages m
  WHERE version = (SELECT max(version) FROM raw_messages o WHERE o._id = m._id)
),
s_messages AS (
  SELECT m._id AS messageId, m.conversationId, m.senderId, u.displayName AS senderName, m.messageType, m.content,
    CAST(coalesce(length(m.content), 0) AS INTEGER) AS contentLength,
    coalesce(len(m.kinds), 0) > 0 AS hasAttachments, CAST(coalesce(len(m.kinds), 0) AS INTEGER) AS attachmentCount,
    coalesce(array_to_string(m.kinds, ','), '') AS attachmentTypes, CAST(len(m.reactors) AS INTEGER) AS reactionCount,
    CAST(len(list_distinct(m.reactors)) AS INTEGER) AS uniqueReactors, m.replyTo IS NOT NULL AS isReply,
    m.replyTo AS replyToMessageId, coalesce(m.isEdited, false) AS isEdited, m.isDeleted,
    coalesce(m.isForwarded, false) AS isForwarded, CAST(len(m.readBy) AS INTEGER) AS readCount, m.createdAt,
    m.updatedAt, CAST(m.createdAt AS DATE) AS d, hour(m.createdAt) AS h,
    dayofweek(m.createdAt) IN (0, 6) AS isWeekend
  FROM latest m
  LEFT JOIN (SELECT _id, max(displayName) AS displayName FROM raw_users GROUP BY 1) u ON u._id = m.senderId
),
sent AS (
  SELECT senderId AS userId, d, count(*) AS messagesSent, count(*) FILTER (WHERE hasAttachments) AS mediaShared,
    sum(reactionCount) AS reactionsReceived, count(DISTINCT conversationId) AS conversationsActive
  FROM s_messages GROUP BY 1, 2
),
reacted AS (
  SELECT senderId AS userId, d, sum(reactionCount) AS reactionsGiven FROM s_messages WHERE reactionCount > 0
  GROUP BY 1, 2
),
made_calls AS (
  SELECT initiatorId AS userId, CAST(createdAt AS DATE) AS d, count(*) AS callsInitiated,
    coalesce(sum(duration) FILTER (WHERE status = 'ended'), 0) AS seconds
  FROM b_calls GROUP BY 1, 2
),
got_calls AS (
  SELECT userId, d, count(*) AS callsReceived
  FROM (SELECT unnest(participantIds) AS userId, CAST(createdAt AS DATE) AS d FROM b_calls) GROUP BY 1, 2
),
started AS (
  SELECT userId, d, count(*) AS newConversationsStarted
  FROM (SELECT senderId AS userId, conversationId, min(d) AS d FROM s_messages GROUP BY 1, 2) GROUP BY 1, 2
),
user_days AS (
  SELECT userId, d FROM sent UNION SELECT userId, d FROM made_calls UNION SELECT userId, d FROM got_calls
),
activity_full AS (
  SELECT x.userId, x.d, coalesce(s.messagesSent, 0) AS messagesSent, 0 AS messagesReceived,
    coalesce(r.reactionsGiven, 0) AS reactionsGiven, coalesce(s.reactionsReceived, 0) AS reactionsReceived,
    coalesce(c.callsInitiated, 0) AS callsInitiated, coalesce(g.callsReceived, 0) AS callsReceived,
    CAST(coalesce(c.seconds, 0) AS DOUBLE) / 60.0 AS minutes,
    coalesce(s.conversationsActive, 0) AS conversationsActive,
    coalesce(n.newConversationsStarted, 0) AS newConversationsStarted, coalesce(s.mediaShared, 0) AS mediaShared,
    s.userId IS NOT NULL AS wrote
  FROM user_days x LEFT JOIN sent s USING (userId, d) LEFT JOIN reacted r USING (userId, d)
  LEFT JOIN made_calls c USING (userId, d) LEFT JOIN got_calls g USING (userId, d)
  LEFT JOIN started n USING (userId, d)
),
activity AS (SELECT * FROM activity_full WHERE wrote),
dau AS (
  SELECT d, count(DISTINCT userId) AS activeUsers, sum(messagesSent) AS totalMessagesSent,
    avg(messagesSent) AS avgMessagesPerUser
  FROM activity WHERE messagesSent > 0 OR callsInitiated > 0 OR callsReceived > 0 GROUP BY 1
),
new_users AS (SELECT CAST(createdAt AS DATE) AS d, count(*) AS newUsers FROM b_users GROUP BY 1),
new_convs AS (SELECT CAST(createdAt AS DATE) AS d, count(*) AS newConversations FROM b_conversations GROUP BY 1),
mix AS (
  SELECT d, count(*) AS totalMessages, count(*) FILTER (WHERE messageType = 'text') AS textMessages,
    count(*) FILTER (WHERE messageType IN ('image', 'video', 'audio', 'file')) AS mediaMessages,
    sum(reactionCount) AS totalReactions, count(DISTINCT conversationId) AS activeConversations
  FROM s_messages GROUP BY 1
),
hours AS (SELECT d, h, count(*) AS n FROM s_messages GROUP BY 1, 2),
peak AS (SELECT DISTINCT ON (d) d, h AS peakHour FROM hours ORDER BY d, n DESC, h DESC),
calls_day AS (
  SELECT CAST(createdAt AS DATE) AS d, count(*) AS totalCalls, count(*) FILTER (WHERE callType = 'audio') AS audioCalls,
    count(*) FILTER (WHERE callType = 'video') AS videoCalls, sum(coalesce(duration, 0)) / 60.0 AS minutes,
    avg(coalesce(duration, 0)) / 60.0 AS avgMinutes
  FROM b_calls GROUP BY 1
),
all_days AS (
  SELECT d FROM dau UNION SELECT d FROM new_users UNION SELECT d FROM mix UNION SELECT d FROM calls_day
  UNION SELECT d FROM new_convs
),
day_facts AS (
  SELECT x.d, coalesce(dau.activeUsers, 0) AS activeUsers, coalesce(dau.avgMessagesPerUser, 0) AS avgMessagesPerUser,
    coalesce(u.newUsers, 0) AS newUsers, coalesce(m.totalMessages, 0) AS totalMessages,
    coalesce(m.textMessages, 0) AS textMessages, coalesce(m.mediaMessages, 0) AS mediaMessages,
    coalesce(m.totalReactions, 0) AS totalReactions, coalesce(m.activeConversations, 0) AS activeConversations,
    coalesce(p.peakHour, 12) AS peakHour, coalesce(c.totalCalls, 0) AS totalCalls,
    coalesce(c.audioCalls, 0) AS audioCalls, coalesce(c.videoCalls, 0) AS videoCalls,
    CAST(coalesce(c.minutes, 0) AS DOUBLE) AS minutes, CAST(coalesce(c.avgMinutes, 0) AS DOUBLE) AS avgMinutes,
    coalesce(v.newConversations, 0) AS newConversations, dau.d IS NOT NULL AS in_dau
  FROM all_days x LEFT JOIN dau USING (d) LEFT JOIN new_users u USING (d) LEFT JOIN mix m USING (d)
  LEFT JOIN peak p USING (d) LEFT JOIN calls_day c USING (d) LEFT JOIN new_convs v USING (d)
),
lifetime AS (
  SELECT userId, sum(messagesSent) AS totalMessagesSent, sum(messagesReceived) AS totalMessagesReceived,
    sum(reactionsGiven) AS totalReactionsGiven, sum(reactionsReceived) AS totalReactionsReceived,
    sum(callsInitiated) AS totalCallsInitiated, sum(callsReceived) AS totalCallsReceived,
    sum(minutes) AS totalMinutes, max(d) AS lastActiveDate
  FROM activity GROUP BY 1
),
last7 AS (
  SELECT userId, sum(messagesSent) AS sent7, sum(reactionsGiven) AS given7, sum(reactionsReceived) AS received7,
    sum(callsInitiated) AS made7, sum(callsReceived) AS got7, sum(minutes) AS minutes7, count(*) AS days7
  FROM activity WHERE d >= {AS_OF} - 7 GROUP BY 1
),
last30 AS (
  SELECT userId, sum(messagesSent) AS sent30, sum(reactionsGiven) AS given30, sum(reactionsReceived) AS received30,
    sum(callsInitiated) AS made30, sum(callsReceived) AS got30, sum(minutes) AS minutes30, count(*) AS days30,
    avg(messagesSent) AS avg30
  FROM activity WHERE d >= {AS_OF} - 30 GROUP BY 1
),
network AS (
  SELECT senderId AS userId, count(DISTINCT conversationId) AS conversationsParticipating FROM s_messages GROUP BY 1
),
group_net AS (
  SELECT m.senderId AS userId, count(DISTINCT m.conversationId) AS groupsParticipating
  FROM s_messages m JOIN b_conversations c ON c._id = m.conversationId AND c.conversationType = 'group' GROUP BY 1
),
scored AS (
  SELECT l.userId, l.lastActiveDate, coalesce(b.sent30, 0) AS sent30, coalesce(a.sent7, 0) AS sent7,
    coalesce(b.given30, 0) AS given30, coalesce(b.made30, 0) AS made30, coalesce(b.got30, 0) AS got30,
    coalesce(a.days7, 0) AS days7, coalesce(b.days30, 0) AS days30, coalesce(b.avg30, 0) AS avg30
  FROM lifetime l LEFT JOIN last30 b USING (userId) LEFT JOIN last7 a USING (userId)
)
"""


def score(messages: str, reactions: str, calls: str, days: str, max_days: int = 30) -> str:
    return (
        f"round(least(CAST({messages} AS DOUBLE) / 100 * 30, 30) + least(CAST({reactions} AS DOUBLE) / 20 * 20, 20)"
        f" + least(CAST({calls} AS DOUBLE) / 10 * 20, 20) + CAST({days} AS DOUBLE) / {max_days} * 30, 2)"
    )


TREND = (
    "CASE WHEN sent30 - sent7 = 0 THEN 'stable' WHEN CAST(sent7 AS DOUBLE) / (sent30 - sent7) > 1.2 THEN 'increasing'"
    " WHEN CAST(sent7 AS DOUBLE) / (sent30 - sent7) < 0.8 THEN 'decreasing' ELSE 'stable' END"
)


def risk(idle: str) -> str:
    return (
        f"CASE WHEN {idle} > 14 THEN 'high' WHEN {idle} > 7 THEN 'medium'"
        " WHEN days7 < CAST(days30 AS DOUBLE) / 4 * 0.5 THEN 'medium' ELSE 'low' END"
    )


SEGMENT = (
    "CASE WHEN days30 >= 25 AND sent30 >= 100 THEN 'power_user' WHEN days30 >= 15 AND sent30 >= 30 THEN 'regular'"
    " WHEN days30 >= 5 THEN 'casual' WHEN days30 >= 1 THEN 'at_risk' ELSE 'churned' END"
)
CHANGE = (
    "_id, conversationId, coalesce(isEdited, false) AS isEdited, coalesce(isForwarded, false) AS isForwarded, "
    f"{ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')}, version"
)
YMD = "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month, CAST(day({0}) AS INTEGER) AS day"
YM = "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month"
DOW = "CAST(dayofweek({0}) + 1 AS INTEGER) AS dayOfWeek"
CALLS = f"""
SELECT _id, initiatorId, array_to_string(participantIds, ',') AS participantIds, conversationId, callType, status,
  {ts("CASE WHEN status <> 'missed' THEN createdAt END", 'startTime')},
  {ts("CASE WHEN status = 'ended' THEN createdAt + to_seconds(duration) END", 'endTime')},
  duration, {ts('createdAt', 'createdAt')}, 'mongodb' AS sourceSystem, {YMD.format('createdAt')}
FROM b_calls"""
ACTIVITY = f"""
SELECT userId, CAST(d AS VARCHAR) AS activityDate, messagesSent, messagesReceived, reactionsGiven, reactionsReceived,
  callsInitiated, callsReceived, round(minutes, 6) AS totalCallDurationMinutes, conversationsActive,
  newConversationsStarted, mediaShared, messagesSent > 0 OR callsInitiated > 0 OR callsReceived > 0 AS isActiveDay,
  {YMD.format('d')}, {DOW.format('d')} FROM """
DAILY = f"""
SELECT CAST(d AS VARCHAR) AS metricDate, sum(newUsers) OVER (ORDER BY d) AS totalUsers, activeUsers, newUsers,
  totalMessages, textMessages, mediaMessages, totalCalls, audioCalls, videoCalls,
  round(minutes, 6) AS totalCallDurationMinutes, round(avgMinutes, 6) AS avgCallDurationMinutes,
  sum(newConversations) OVER (ORDER BY d) AS totalConversations, activeConversations, newConversations,
  totalReactions, round(avgMessagesPerUser, 6) AS avgMessagesPerUser, 1.0::DOUBLE AS avgSessionsPerUser,
  CAST(peakHour AS INTEGER) AS peakHour, {YMD.format('d')}, {DOW.format('d')}, dayofweek(d) IN (0, 6) AS isWeekend
FROM day_facts """

ORACLE: dict[str, str] = {}


def add(name: str, sql: str, extra: str = "") -> None:
    """Register a query; ``extra`` holds further common table expressions."""
    ORACLE[name] = WITH_ + (", " + extra if extra else "") + sql


add("landing_scan", f"""
SELECT _id AS oid, conversationId, senderId, messageType AS type, content,
  array_to_string([ 'https://media.example.com/' || x || '-' || _id FOR x IN kinds], ',') AS urls,
  array_to_string(['e' || i FOR i IN range(len(reactors))], ',') AS emojis, replyTo, isEdited, isDeleted, isForwarded,
  array_to_string(readBy, ',') AS readBy, {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')},
  {ts('expiresAt', 'expiresAt')}
FROM raw_messages""")
add("auth_scan", f"""
SELECT id AS authUserId, email AS authEmail, email_verified AS emailVerified, two_factor_enabled AS twoFactorEnabled,
  {ts('last_login_at', 'lastLoginAt')}, login_count AS loginCount, {ts('created_at', 'authCreatedAt')}
FROM raw_auth""")
for name in ("write_read_roundtrip", "compact_rewrite", "bronze_calls"):
    add(name, CALLS)
for name in ("merge_upsert", "merge_partitions"):
    add(name, f"""
SELECT {CHANGE} FROM raw_messages WHERE version = 1
UNION ALL
SELECT {CHANGE} FROM raw_messages
WHERE version = 0 AND NOT coalesce(isForwarded, false) AND _id NOT IN (SELECT _id FROM raw_messages WHERE version = 1)""")
for name in ("as_of_version", "dedup_latest"):
    add(name, f"SELECT {CHANGE} FROM latest")
add("as_of_timestamp", f"""
SELECT {CHANGE} FROM (
  SELECT DISTINCT ON (_id) * FROM raw_messages WHERE updatedAt <= TIMESTAMP '2024-01-15 12:00:00'
  ORDER BY _id, updatedAt DESC, version DESC)""")
add("cluster_rewrite", f"""
SELECT messageId, conversationId, senderId, messageType, {ts('createdAt', 'createdAt')} FROM s_messages""")
add("replace_snapshot", f"SELECT {CHANGE} FROM raw_messages WHERE version = 1")
add("incremental_load", f"""
SELECT {CHANGE} FROM raw_messages
WHERE version = 0 AND createdAt > (SELECT max(createdAt) FROM msg0 WHERE createdAt < TIMESTAMP '2024-01-20')""")
add("incremental_first_load", f"""
SELECT {CHANGE} FROM raw_messages WHERE version = 0 AND createdAt >= TIMESTAMP '2024-01-30'""")
add("retention_filter", f"""
SELECT _id, {ts('createdAt', 'createdAt')}, {YMD.format('createdAt')} FROM raw_messages
WHERE CAST(createdAt AS DATE) >= DATE '2024-04-10' - 90""")

add("bronze_projection", f"""
SELECT _id, conversationId, senderId, messageType, content, CAST(coalesce(len(kinds), 0) AS INTEGER) AS attachments,
  CAST(len(reactors) AS INTEGER) AS reactions, replyTo, coalesce(isEdited, false) AS isEdited, isDeleted,
  coalesce(isForwarded, false) AS isForwarded, array_to_string(readBy, ',') AS readBy,
  {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')}, {ts('expiresAt', 'expiresAt')},
  'mongodb' AS sourceSystem, {YMD.format('createdAt')}
FROM raw_messages""")
add("flatten_struct", f"""
SELECT senderId, {ts('updatedAt', 'updatedAt')}, reactors[1] AS reaction_userId,
  CASE WHEN len(reactors) > 0 THEN 'e0' END AS reaction_emoji,
  {ts('CASE WHEN len(reactors) > 0 THEN createdAt END', 'reaction_createdAt')}, _id AS oid
FROM raw_messages""")
add("required_fields", f"""
SELECT _id, email, {ts('lastSeen', 'lastSeen')} FROM raw_users WHERE email IS NOT NULL AND lastSeen IS NOT NULL""")
add("active_days", "SELECT userId, CAST(d AS VARCHAR) AS activityDate, messagesSent FROM activity")
add("rolling_filter", f"""
SELECT messageId, messageType, {ts('createdAt', 'createdAt')} FROM s_messages
WHERE createdAt >= CAST({AS_OF} - 7 AS TIMESTAMP) AND messageType IN ('image', 'video', 'audio', 'file')
  AND NOT isDeleted""")
add("fill_nulls", """
SELECT _id, coalesce(role, 'user') AS role, coalesce(isOnline, false) AS isOnline, status,
  coalesce(isBanned, false) AS isBanned,
  CAST(coalesce(date_diff('day', createdAt, lastSeen), -1) AS INTEGER) AS seenAfterDays
FROM raw_users""")
add("clean_strings", "SELECT _id, lower(displayName) AS displayName, role FROM raw_users")
add("metadata_columns", """
SELECT _id, 'mongodb+mysql' AS sourceSystem, '1.0.0' AS version, true AS stamped FROM raw_users""")
add("time_partitions", f"""
SELECT event_id, {ts('ts', 'ts')}, {YMD.format('ts')}, CAST(hour(ts) AS INTEGER) AS hour, {DOW.format('ts')},
  dayofweek(ts) IN (0, 6) AS isWeekend
FROM events""")

add("users_auth_left", f"""
SELECT _id, email, emailVerified, twoFactorEnabled, {ts('lastLoginAt', 'lastLoginAt')}, loginCount FROM b_users""")
add("sender_lookup", f"""
SELECT m._id, m.senderId, {ts('m.updatedAt', 'updatedAt')}, u.displayName AS senderName
FROM raw_messages m LEFT JOIN raw_users u ON u._id = m.senderId""")
add("activity_spine", """
SELECT userId, CAST(d AS VARCHAR) AS activityDate, messagesSent, mediaShared, reactionsReceived, conversationsActive,
  coalesce(reactionsGiven, 0) AS reactionsGiven, coalesce(callsInitiated, 0) AS callsInitiated,
  coalesce(seconds, 0) AS totalCallDurationSeconds, coalesce(callsReceived, 0) AS callsReceived,
  coalesce(newConversationsStarted, 0) AS newConversationsStarted
FROM sent LEFT JOIN reacted USING (userId, d) LEFT JOIN made_calls USING (userId, d)
LEFT JOIN got_calls USING (userId, d) LEFT JOIN started USING (userId, d)""")
add("user_spine", """
SELECT u._id AS userId, l.totalMessagesSent, CAST(l.lastActiveDate AS VARCHAR) AS lastActiveDate,
  n.conversationsParticipating
FROM b_users u LEFT JOIN lifetime l ON l.userId = u._id LEFT JOIN network n ON n.userId = u._id""")
add("date_spine", """
SELECT CAST(d AS VARCHAR) AS metricDate, activeUsers, newUsers, totalCalls
FROM dau LEFT JOIN new_users USING (d) LEFT JOIN calls_day USING (d)""")
add("group_messages", """
SELECT m.messageId, m.senderId, m.conversationId FROM s_messages m
JOIN b_conversations c ON c._id = m.conversationId WHERE c.conversationType = 'group'""")

DAY = "CAST(d AS VARCHAR) AS activityDate"
add("message_activity", f"""
SELECT userId, {DAY}, messagesSent, mediaShared, reactionsReceived, conversationsActive FROM sent""")
add("conversation_day_counts", f"""
SELECT conversationId, {DAY}, count(*) AS messagesInConv FROM s_messages GROUP BY conversationId, d""")
add("reactions_by_day", f"SELECT userId, {DAY}, reactionsGiven FROM reacted")
add("reactions_given_true", f"""
SELECT userId, {DAY}, count(*) AS reactionsGiven
FROM (SELECT unnest(reactors) AS userId, CAST(createdAt AS DATE) AS d FROM latest) GROUP BY userId, d""")
add("calls_initiated", f"SELECT userId, {DAY}, callsInitiated, seconds AS totalCallDurationSeconds FROM made_calls")
add("calls_received", f"SELECT userId, {DAY}, callsReceived FROM got_calls")
add("first_touch", f"SELECT userId, {DAY}, newConversationsStarted FROM started")
METRIC = "CAST(d AS VARCHAR) AS metricDate"
add("new_users_daily", f"SELECT {METRIC}, newUsers FROM new_users")
add("new_conversations_daily", f"SELECT {METRIC}, newConversations FROM new_convs")
add("distinct_user_dates", """
SELECT DISTINCT _id AS userId, CAST(CAST(createdAt AS DATE) AS VARCHAR) AS createdDate FROM b_users""")
add("dau", f"""
SELECT {METRIC}, activeUsers, totalMessagesSent, round(avgMessagesPerUser, 6) AS avgMessagesPerUser FROM dau""")
add("message_mix", f"SELECT {METRIC}, totalMessages, textMessages, mediaMessages, totalReactions FROM mix")
add("peak_hour", f"SELECT {METRIC}, CAST(peakHour AS INTEGER) AS peakHour FROM peak")
add("call_metrics", f"""
SELECT {METRIC}, totalCalls, audioCalls, videoCalls, round(CAST(minutes AS DOUBLE), 6) AS totalCallDurationMinutes,
  round(CAST(avgMinutes AS DOUBLE), 6) AS avgCallDurationMinutes
FROM calls_day""")
add("active_conversations", f"SELECT {METRIC}, activeConversations FROM mix")
add("activity_7_30", """
SELECT userId, sent7 AS messagesSentLast7, CASE WHEN days7 > 0 THEN 0 END AS messagesReceivedLast7,
  given7 AS reactionsGivenLast7, received7 AS reactionsReceivedLast7, made7 AS callsInitiatedLast7,
  got7 AS callsReceivedLast7, round(minutes7, 6) AS callDurationLast7, days7 AS activeDaysLast7,
  sent30 AS messagesSentLast30, 0 AS messagesReceivedLast30, given30 AS reactionsGivenLast30,
  received30 AS reactionsReceivedLast30, made30 AS callsInitiatedLast30, got30 AS callsReceivedLast30,
  round(minutes30, 6) AS callDurationLast30, days30 AS activeDaysLast30, days30 AS uniqueActiveDaysLast30,
  round(avg30, 6) AS avgDailyMessagesLast30
FROM last30 LEFT JOIN last7 USING (userId)""")
add("lifetime_totals", """
SELECT userId, totalMessagesSent, totalMessagesReceived, totalReactionsGiven, totalReactionsReceived,
  totalCallsInitiated, totalCallsReceived, round(totalMinutes, 6) AS totalCallDurationMinutes,
  CAST(lastActiveDate AS VARCHAR) AS lastActiveDate
FROM lifetime""")
add("user_totals_carried", """
SELECT l.userId, b.sent30 AS messagesSentLast30, CASE WHEN b.days30 > 0 THEN 0 END AS messagesReceivedLast30,
  b.given30 AS reactionsGivenLast30, b.received30 AS reactionsReceivedLast30, b.made30 AS callsInitiatedLast30,
  b.got30 AS callsReceivedLast30, b.days30 AS activeDaysLast30, round(b.minutes30, 6) AS callDurationLast30,
  a.sent7 AS messagesSentLast7, CASE WHEN a.days7 > 0 THEN 0 END AS messagesReceivedLast7,
  a.given7 AS reactionsGivenLast7, a.received7 AS reactionsReceivedLast7, a.made7 AS callsInitiatedLast7,
  a.got7 AS callsReceivedLast7, a.days7 AS activeDaysLast7, round(a.minutes7, 6) AS callDurationLast7,
  round(b.avg30, 6) AS avgDailyMessagesLast30, totalMessagesSent, totalMessagesReceived, totalReactionsGiven,
  totalReactionsReceived, totalCallsInitiated, totalCallsReceived, round(totalMinutes, 6) AS totalCallDurationMinutes,
  CAST(lastActiveDate AS VARCHAR) AS lastActiveDate
FROM lifetime l LEFT JOIN last30 b ON b.userId = l.userId LEFT JOIN last7 a ON a.userId = l.userId""")
add("network_size", "SELECT userId, conversationsParticipating FROM network")
add("groups_per_user", "SELECT userId, groupsParticipating FROM group_net")

FEATURES = f"""
f_activity AS (
  SELECT userId,
    coalesce(sum(messagesSent) FILTER (WHERE d >= {AS_OF} - 1), 0) AS sent1,
    coalesce(sum(messagesSent) FILTER (WHERE d >= {AS_OF} - 7), 0) AS sent7,
    coalesce(sum(messagesSent) FILTER (WHERE d >= {AS_OF} - 30), 0) AS sent30,
    count(*) FILTER (WHERE d >= {AS_OF} - 7) AS days7, count(*) FILTER (WHERE d >= {AS_OF} - 30) AS days30,
    avg(CASE WHEN d >= {AS_OF} - 30 THEN minutes ELSE 0 END) AS session,
    coalesce(sum(messagesSent) FILTER (WHERE d BETWEEN {AS_OF} - 14 AND {AS_OF} - 8), 0) AS before7,
    max(d) AS last
  FROM activity GROUP BY 1
),
recent AS (SELECT *, senderId AS userId FROM s_messages WHERE createdAt >= CAST({AS_OF} - 30 AS TIMESTAMP)),
f_messages AS (
  SELECT userId, count(DISTINCT conversationId) AS contacts,
    CAST(count(*) FILTER (WHERE NOT isWeekend) AS DOUBLE) / count(*) AS weekday
  FROM recent GROUP BY 1
),
f_hour AS (
  SELECT DISTINCT ON (userId) userId, h FROM (SELECT userId, h, count(*) AS n FROM recent GROUP BY 1, 2)
  ORDER BY userId, n DESC, h
),
f_groups AS (
  SELECT userId, count(*) AS groups, avg(members) AS size FROM (
    SELECT DISTINCT m.senderId AS userId, c._id, len(c.participants) AS members
    FROM s_messages m JOIN b_conversations c ON c._id = m.conversationId AND c.conversationType = 'group'
  ) GROUP BY 1
)
"""
add("feature_windows", """
SELECT userId, sent1 AS msgSentLast1d, 0 AS msgRecvLast1d, sent7 AS msgSentLast7d, 0 AS msgRecvLast7d,
  days7 AS activeDaysLast7d, sent30 AS msgSentLast30d, 0 AS msgRecvLast30d, days30 AS activeDaysLast30d,
  round(session, 6) AS avgSessionDurationMinutes, CAST(last AS VARCHAR) AS lastActiveDate
FROM f_activity""", FEATURES)
add("social_features", """
SELECT userId, contacts AS uniqueContacts, 0 AS groupCount, 5.0::DOUBLE AS avgGroupSize FROM f_messages""", FEATURES)
add("group_features", "SELECT userId, groups AS groupCount, round(size, 6) AS avgGroupSize FROM f_groups", FEATURES)
add("temporal_features", """
SELECT userId, CAST(h AS INTEGER) AS preferredHour, round(weekday, 6) AS weekdayActivityRatio
FROM f_messages JOIN f_hour USING (userId)""", FEATURES)
add("velocity", """
SELECT userId, round(CAST(sent7 AS DOUBLE) / 7.0, 6) AS messageVelocity7d,
  CAST(sent7 - before7 AS DOUBLE) AS engagementTrend
FROM f_activity""", FEATURES)
add("churn_label", f"SELECT userId, {AS_OF} - last > 7 AS willChurnNext7d FROM f_activity", FEATURES)
add("high_water_mark", f"""
SELECT {ts('max(updatedAt)', 'high_water_mark')}, {ts('max(createdAt)', '"newestCreated"')} FROM raw_messages""")
add("row_counts", """
SELECT 'messages' AS "table", (SELECT count(*) FROM raw_messages) AS rows
UNION ALL SELECT 'users', (SELECT count(*) FROM customer)
UNION ALL SELECT 'calls', (SELECT count(*) FROM orders)""")
add("dedup_earliest", f"""
SELECT _id, senderId, conversationId, {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')} FROM (
  SELECT DISTINCT ON (senderId, conversationId) * FROM raw_messages
  ORDER BY senderId, conversationId, updatedAt, _id DESC)""")
add("running_totals", f"""
SELECT {METRIC}, newUsers, (SELECT sum(o.newUsers) FROM new_users o WHERE o.d <= n.d) AS totalUsers
FROM new_users n""")

add("date_parts", f"""
SELECT {YMD.format('l_shipdate')}, CAST(hour(l_shipdate) AS INTEGER) AS hour, {DOW.format('l_shipdate')},
  dayofweek(l_shipdate) IN (0, 6) AS isWeekend, count(*) AS lines
FROM lineitem GROUP BY ALL""")
add("date_math", f"""
SELECT _id AS userId, CAST(date_diff('day', createdAt, lastSeen) AS INTEGER) AS daysBetween,
  CAST({AS_OF} - CAST(createdAt AS DATE) AS INTEGER) AS daysSince,
  CAST(CAST(createdAt AS DATE) - 7 AS VARCHAR) AS weekBefore, {ts('createdAt - INTERVAL 36 HOUR', 'hoursBefore')}
FROM raw_users""")
add("string_lengths", """
SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, CAST(length(trim(text, ' ')) AS INTEGER) AS trimmedChars,
  text IS NOT NULL AND text <> '' AS hasText, lower(lang) = 'en' AS isEnglish
FROM documents""")
add("array_sizes", f"""
SELECT _id, {ts('updatedAt', 'updatedAt')}, CAST(coalesce(len(kinds), 0) AS INTEGER) AS attachments,
  CAST(len(reactors) AS INTEGER) AS reactions, CAST(coalesce(len(kinds), 0) AS INTEGER) AS attachmentsOrEmpty
FROM raw_messages""")
add("attachment_types", f"""
SELECT _id, {ts('updatedAt', 'updatedAt')}, coalesce(array_to_string(kinds, ','), '') AS types FROM raw_messages""")
add("unique_reactors", f"""
SELECT _id, {ts('updatedAt', 'updatedAt')}, CAST(len(list_distinct(reactors)) AS INTEGER) AS reactors
FROM raw_messages""")
add("json_parse", """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
  CAST(NULL AS VARCHAR) AS absent
FROM events""")
add("engagement_score", f"""
SELECT userId, {score('sent30', 'given30', 'made30', 'days30')} AS score,
  least({score('sent30', 'given30', 'made30', 'days30')}, 100) AS capped
FROM scored WHERE days30 > 0""")
add("activity_trend", f"SELECT userId, {TREND} AS trend FROM scored WHERE days30 > 0")
add("churn_risk", f"SELECT userId, {risk(f'({AS_OF} - lastActiveDate)')} AS risk FROM scored")
add("user_segment", f"SELECT userId, {SEGMENT} AS segment FROM scored WHERE days30 > 0")
add("conversation_health", f"""
SELECT _id, CAST(weekEnd AS VARCHAR) AS weekEnd, CASE WHEN idle > 30 THEN 'dead' WHEN idle > 14 THEN 'dying'
  WHEN recent < 3 THEN 'quiet' WHEN recent >= 10 THEN 'thriving' ELSE 'active' END AS health
FROM (
  SELECT c._id, w.weekEnd, count(m.messageId) FILTER (WHERE w.weekEnd - m.d <= 7) AS recent,
    coalesce(w.weekEnd - max(m.d), 999) AS idle
  FROM b_conversations c
  CROSS JOIN (SELECT unnest([DATE '2024-01-10', DATE '2024-01-17', DATE '2024-01-24', DATE '2024-01-31',
    DATE '2024-02-20']) AS weekEnd) w
  LEFT JOIN s_messages m ON m.conversationId = c._id AND m.d <= w.weekEnd
  GROUP BY c._id, w.weekEnd)""")
DURATION = "CASE WHEN duration < 60 THEN 'short' WHEN duration < 600 THEN 'medium' ELSE 'long' END"
add("duration_category", f"SELECT _id, {DURATION} AS category FROM b_calls")
add("categorize", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal < 1000 THEN 'low'
  WHEN c_acctbal >= 1000 AND c_acctbal < 5000 THEN 'mid' WHEN c_acctbal >= 4000 AND c_acctbal < 9000 THEN 'high'
  ELSE 'unknown' END AS bucket
FROM customer""")

add("stream_messages", f"""
SELECT _id, conversationId, senderId, messageType, content,
  coalesce(array_to_string([ 'https://media.example.com/' || x || '-' || _id FOR x IN kinds], ','), '') AS urls,
  CAST(len(reactors) AS INTEGER) AS reactions, replyTo, coalesce(isEdited, false) AS isEdited, isDeleted,
  coalesce(isForwarded, false) AS isForwarded, {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')},
  'kafka' AS sourceSystem, {YMD.format('createdAt')}
FROM raw_messages""")
add("stream_events", f"""
SELECT CAST(event_id AS VARCHAR) AS eventId, event_type AS eventType, 'message' AS entityType,
  CAST(event_id % 100 AS VARCHAR) AS entityId, CAST(user_id AS VARCHAR) AS userId, props AS payload,
  {ts('ts', '"timestamp"')}, 'kafka' AS sourceSystem, {YMD.format('ts')}
FROM events""")
add("stream_live_metrics", f"""
SELECT {ts('w', 'windowStart')}, {ts('w + INTERVAL 1 MINUTE', 'windowEnd')}, count(*) AS messageCount,
  count(DISTINCT senderId) AS activeUsers, count(DISTINCT conversationId) AS activeConversations,
  round(avg(length(content)), 6) AS avgMessageLength
FROM (SELECT *, date_trunc('minute', createdAt) AS w FROM raw_messages)
GROUP BY w""")
add("stream_live_metrics_final", f"""
SELECT {ts('w', 'windowStart')}, {ts('w + INTERVAL 1 MINUTE', 'windowEnd')}, count(*) AS messageCount,
  count(DISTINCT senderId) AS activeUsers, count(DISTINCT conversationId) AS activeConversations,
  round(avg(length(content)), 6) AS avgMessageLength
FROM (SELECT *, date_trunc('minute', createdAt) AS w FROM raw_messages)
GROUP BY w
HAVING w + INTERVAL 1 MINUTE <= (SELECT max(createdAt) FROM raw_messages) - INTERVAL 10 MINUTE""")
add("stream_live_metrics_approx", f"""
SELECT {ts('w', 'windowStart')}, {ts('w + INTERVAL 1 MINUTE', 'windowEnd')}, count(*) AS messageCount,
  true AS usersClose, true AS conversationsClose, round(avg(length(content)), 6) AS avgMessageLength
FROM (SELECT *, date_trunc('minute', createdAt) AS w FROM raw_messages)
GROUP BY w""")
add("stream_and_batch_messages", f"""
SELECT _id, senderId, coalesce(isEdited, false) AS isEdited,
  CASE WHEN createdAt < TIMESTAMP '2024-01-16' THEN 'mongodb' ELSE 'kafka' END AS sourceSystem,
  {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')}
FROM latest""")
add("stream_dedup", f"SELECT _id, conversationId, senderId, {ts('createdAt', 'createdAt')} FROM msg0")
add("stream_two_queries", f"""
SELECT 'messages' AS "table", {YMD.format('createdAt')}, count(*) AS rows FROM raw_messages GROUP BY ALL
UNION ALL
SELECT 'events' AS "table", {YMD.format('ts')}, count(*) AS rows FROM events GROUP BY ALL""")

add("bronze_messages", f"""
SELECT _id, conversationId, senderId, messageType, content,
  coalesce(array_to_string([x || '-' || _id FOR x IN kinds], ','), '') AS attachments,
  array_to_string([reactors[i + 1] || ':e' || i FOR i IN range(len(reactors))], ',') AS reactions, replyTo,
  coalesce(isEdited, false) AS isEdited, isDeleted, coalesce(isForwarded, false) AS isForwarded,
  array_to_string(readBy, ',') AS readBy, {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')},
  {ts('expiresAt', 'expiresAt')}, 'mongodb' AS sourceSystem, {YMD.format('createdAt')}
FROM raw_messages""")
add("bronze_users", f"""
SELECT _id, phoneNumber, email, username, displayName, avatar, bio, status, {ts('lastSeen', 'lastSeen')}, isOnline,
  role, isBanned, isVerified, emailVerified, twoFactorEnabled, {ts('lastLoginAt', 'lastLoginAt')}, loginCount,
  {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')}, 'mongodb+mysql' AS sourceSystem,
  {YM.format('createdAt')}
FROM b_users""")
add("bronze_conversations", f"""
SELECT _id, conversationType, name, avatar, array_to_string(participants, ',') AS participants,
  array_to_string(admins, ',') AS admins, lastMessageId, {ts('lastMessageAt', 'lastMessageAt')}, isArchived, isLocked,
  createdBy, {ts('createdAt', 'createdAt')}, {ts('createdAt', 'updatedAt')}, 'mongodb' AS sourceSystem,
  {YM.format('createdAt')}
FROM b_conversations""")
add("silver_messages", f"""
SELECT messageId, conversationId, senderId, senderName, messageType, content, contentLength, hasAttachments,
  attachmentCount, attachmentTypes, reactionCount, uniqueReactors, isReply, replyToMessageId, isEdited, isDeleted,
  isForwarded, readCount, {ts('createdAt', 'createdAt')}, {ts('updatedAt', 'updatedAt')}, {YMD.format('createdAt')},
  CAST(h AS INTEGER) AS hour, {DOW.format('createdAt')}, isWeekend
FROM s_messages""")
add("silver_users", f"""
SELECT _id AS userId, phoneNumber, email, username, displayName, coalesce(avatar, '') <> '' AS hasAvatar,
  coalesce(bio, '') <> '' AS hasBio, status, {ts('lastSeen', 'lastSeen')},
  CAST({AS_OF} - CAST(lastSeen AS DATE) AS INTEGER) AS lastSeenDaysAgo, isOnline, role, isBanned, isVerified,
  CAST({AS_OF} - CAST(createdAt AS DATE) AS INTEGER) AS accountAgeDays, {ts('createdAt', 'createdAt')},
  {ts('updatedAt', 'updatedAt')}, {YM.format('createdAt')}
FROM b_users""")
add("user_activity", ACTIVITY + "activity")
add("user_activity_full", ACTIVITY + "activity_full")
add("daily_metrics", DAILY + "WHERE in_dau")
add("daily_metrics_full", DAILY)
add("daily_metrics_carried", DAILY)
IDLE = f"coalesce({AS_OF} - lastActiveDate, 999)"
ENGAGED = """
engaged AS (
  SELECT u._id AS userId, l.*  EXCLUDE (userId), coalesce(b.sent30, 0) AS sent30, coalesce(a.sent7, 0) AS sent7,
    coalesce(b.given30, 0) AS given30, coalesce(b.made30 + b.got30, 0) AS calls30, coalesce(a.days7, 0) AS days7,
    coalesce(b.days30, 0) AS days30, coalesce(b.avg30, 0) AS avg30,
    coalesce(n.conversationsParticipating, 0) AS convs, coalesce(g.groupsParticipating, 0) AS groups
  FROM b_users u LEFT JOIN lifetime l ON l.userId = u._id LEFT JOIN last30 b ON b.userId = u._id
  LEFT JOIN last7 a ON a.userId = u._id LEFT JOIN network n ON n.userId = u._id
  LEFT JOIN group_net g ON g.userId = u._id
)
"""
add("user_engagement", f"""
SELECT userId, CAST({AS_OF} AS VARCHAR) AS calculationDate, coalesce(totalMessagesSent, 0) AS totalMessagesSent,
  coalesce(totalMessagesReceived, 0) AS totalMessagesReceived, coalesce(totalReactionsGiven, 0) AS totalReactionsGiven,
  coalesce(totalReactionsReceived, 0) AS totalReactionsReceived,
  coalesce(totalCallsInitiated, 0) AS totalCallsInitiated, coalesce(totalCallsReceived, 0) AS totalCallsReceived,
  round(coalesce(totalMinutes, 0), 6) AS totalCallDurationMinutes, days7 AS activeDaysLast7,
  days30 AS activeDaysLast30, round(avg30, 6) AS avgDailyMessages, CAST(NULL AS DOUBLE) AS avgResponseTimeMinutes,
  convs AS uniqueContactsMessaged, convs AS conversationsParticipating, 0 AS groupsParticipating,
  {score('sent30', 'given30', 'calls30', 'days30')} AS engagementScore, {TREND} AS activityTrend,
  {risk(IDLE)} AS churnRisk, {SEGMENT} AS userSegment, {YM.format(AS_OF)}
FROM engaged""", ENGAGED)
add("user_engagement_groups", f"""
SELECT userId, groups AS groupsParticipating,
  least({score('sent30', 'given30', 'calls30', 'days30')}, 100) AS engagementScore
FROM engaged""", ENGAGED)
add("user_features", f"""
SELECT u._id AS userId, CAST({AS_OF} AS VARCHAR) AS featureDate, coalesce(sent1, 0) AS msgSentLast1d,
  coalesce(sent7, 0) AS msgSentLast7d, coalesce(sent30, 0) AS msgSentLast30d, 0 AS msgRecvLast1d, 0 AS msgRecvLast7d,
  0 AS msgRecvLast30d, coalesce(days7, 0) AS activeDaysLast7d, coalesce(days30, 0) AS activeDaysLast30d,
  round(coalesce(session, 0), 6) AS avgSessionDurationMinutes, coalesce(contacts, 0) AS uniqueContacts,
  0 AS groupCount, CASE WHEN n.userId IS NOT NULL THEN 5.0::DOUBLE ELSE 0 END AS avgGroupSize,
  CAST(coalesce(h, 12) AS INTEGER) AS preferredHour, round(coalesce(weekday, 0), 6) AS weekdayActivityRatio,
  round(coalesce(CAST(sent7 AS DOUBLE) / 7.0, 0), 6) AS messageVelocity7d,
  CAST(coalesce(sent7 - before7, 0) AS DOUBLE) AS engagementTrend, {AS_OF} - last > 7 AS willChurnNext7d
FROM b_users u LEFT JOIN f_activity a ON a.userId = u._id LEFT JOIN f_messages m ON m.userId = u._id
LEFT JOIN f_hour h ON h.userId = u._id LEFT JOIN network n ON n.userId = u._id""", FEATURES)
add("silver_conversations", f"""
SELECT _id AS conversationId, conversationType, name, coalesce(avatar, '') <> '' AS hasAvatar,
  CAST(len(participants) AS INTEGER) AS participantCount, CAST(len(admins) AS INTEGER) AS adminCount,
  lastMessageId IS NOT NULL AS hasLastMessage, {ts('lastMessageAt', 'lastMessageAt')},
  CAST({AS_OF} - CAST(lastMessageAt AS DATE) AS INTEGER) AS daysSinceLastMessage, isArchived, isLocked,
  coalesce({AS_OF} - CAST(lastMessageAt AS DATE) <= 30, false) AS isActive, createdBy,
  {ts('createdAt', 'createdAt')}, {ts('createdAt', 'updatedAt')},
  CAST({AS_OF} - CAST(createdAt AS DATE) AS INTEGER) AS conversationAgeDays, {YM.format('createdAt')}
FROM b_conversations""")
add("silver_calls", f"""
SELECT _id AS callId, initiatorId, CAST(len(participantIds) AS INTEGER) AS participantCount, conversationId, callType,
  status, status = 'ended' AS isCompleted, status = 'missed' AS isMissed,
  {ts("CASE WHEN status <> 'missed' THEN createdAt END", 'startTime')},
  {ts("CASE WHEN status = 'ended' THEN createdAt + to_seconds(duration) END", 'endTime')},
  duration AS durationSeconds, round(CAST(duration AS DOUBLE) / 60.0, 6) AS durationMinutes,
  {DURATION} AS durationCategory, {ts('createdAt', 'createdAt')}, {YMD.format('createdAt')},
  CAST(hour(createdAt) AS INTEGER) AS hour
FROM b_calls""")


def periods(unit: str, step: str) -> str:
    """Per-period users and their comparison with the period before."""
    return f"""
running AS (SELECT *, sum(newUsers) OVER (ORDER BY d) AS totalUsers FROM day_facts),
roll AS (
  SELECT CAST(date_trunc('{unit}', d) AS DATE) AS p, max(totalUsers) AS totalUsers, sum(newUsers) AS newUsers,
    sum(totalMessages) AS totalMessages, sum(totalCalls) AS totalCalls, sum(minutes) / 60.0 AS hours_,
    avg(CASE WHEN activeUsers > 0 THEN activeUsers END) AS meanDau
  FROM running GROUP BY 1
),
up AS (
  SELECT userId, CAST(date_trunc('{unit}', d) AS DATE) AS p, sum(messagesSent) AS m, sum(reactionsGiven) AS r,
    sum(callsInitiated + callsReceived) AS c, count(*) AS days
  FROM activity GROUP BY 1, 2
),
act AS (SELECT p, count(*) AS n, avg({score('m', 'r', 'c', 'days', 7)}) AS score FROM up GROUP BY 1),
ret AS (
  SELECT b.p, count(*) AS n FROM up a JOIN up b ON a.userId = b.userId AND CAST(a.p + INTERVAL {step} AS DATE) = b.p
  GROUP BY 1
),
lost AS (
  SELECT CAST(a.p + INTERVAL {step} AS DATE) AS p, count(*) AS n FROM up a
  WHERE NOT EXISTS (SELECT 1 FROM up b WHERE b.userId = a.userId AND b.p = CAST(a.p + INTERVAL {step} AS DATE))
  GROUP BY 1
),
before_ AS (SELECT CAST(p + INTERVAL {step} AS DATE) AS p, n FROM act),
joined AS (
  SELECT roll.*, coalesce(act.n, 0) AS active, coalesce(act.score, 0) AS score, coalesce(ret.n, 0) AS returning_,
    coalesce(lost.n, 0) AS churned,
    CASE WHEN before_.n > 0 THEN coalesce(ret.n, 0) / CAST(before_.n AS DOUBLE) END AS retention
  FROM roll LEFT JOIN act USING (p) LEFT JOIN ret USING (p) LEFT JOIN lost USING (p) LEFT JOIN before_ USING (p)
)
"""


add("weekly_metrics", """
SELECT CAST(p AS VARCHAR) AS weekStartDate, CAST(p + 6 AS VARCHAR) AS weekEndDate,
  CAST(weekofyear(p) AS INTEGER) AS weekNumber, totalUsers, active AS weeklyActiveUsers, newUsers,
  returning_ AS returningUsers, churned AS churnedUsers, round(retention, 6) AS retentionRate, totalMessages,
  round(CAST(totalMessages AS DOUBLE) / 7.0, 6) AS avgDailyMessages, totalCalls,
  round(CAST(totalCalls AS DOUBLE) / 7.0, 6) AS avgDailyActiveCalls, round(hours_, 6) AS totalCallDurationHours,
  round(score, 6) AS engagementScore, CAST(year(p) AS INTEGER) AS year
FROM joined""", periods("week", "7 DAY"))
add("monthly_metrics", f"""
SELECT CAST(p AS VARCHAR) AS monthDate, strftime(p, '%Y-%m') AS yearMonth, totalUsers, active AS monthlyActiveUsers,
  newUsers, churned AS churnedUsers, round(retention, 6) AS retentionRate,
  round(CASE WHEN active > 0 THEN meanDau / active END, 6) AS dauMauRatio, totalMessages,
  round(CAST(totalMessages AS DOUBLE) / day(last_day(p)), 6) AS avgDailyMessages, totalCalls,
  round(hours_, 6) AS totalCallDurationHours,
  round(CASE WHEN active > 0 THEN CAST(totalMessages AS DOUBLE) / active END, 6) AS avgMessagesPerActiveUser,
  types AS topMessageTypes, CAST(dow + 1 AS INTEGER) AS peakDayOfWeek, {YM.format('p')}
FROM joined LEFT JOIN kinds_ USING (p) LEFT JOIN peak_dow USING (p)""", periods("month", "1 MONTH") + """,
kinds_ AS (
  SELECT p, string_agg(messageType || '=' || n, ',' ORDER BY messageType) AS types
  FROM (SELECT CAST(date_trunc('month', d) AS DATE) AS p, messageType, count(*) AS n FROM s_messages GROUP BY 1, 2)
  GROUP BY 1
),
peak_dow AS (
  SELECT DISTINCT ON (p) p, dow
  FROM (SELECT CAST(date_trunc('month', f.d) AS DATE) AS p, w.dow,
          sum(CASE WHEN dayofweek(f.d) = w.dow THEN f.totalMessages ELSE 0 END) AS n
        FROM day_facts f CROSS JOIN range(7) w(dow) GROUP BY 1, 2)
  ORDER BY p, n DESC, dow
)
""")
add("conversation_analytics", f"""
SELECT c._id AS conversationId, CAST({AS_OF} AS VARCHAR) AS calculationDate, c.conversationType,
  CAST(len(c.participants) AS INTEGER) AS participantCount, coalesce(t.n, 0) AS totalMessages,
  coalesce(t.n7, 0) AS totalMessagesLast7Days, coalesce(t.n30, 0) AS totalMessagesLast30Days,
  CAST(coalesce(t.people7, 0) AS INTEGER) AS uniqueParticipantsLast7Days,
  round(CAST(coalesce(t.n, 0) AS DOUBLE) / greatest({AS_OF} - CAST(c.createdAt AS DATE), 1), 6) AS avgMessagesPerDay,
  round(CAST(coalesce(t.n, 0) AS DOUBLE) / greatest(len(c.participants), 1), 6) AS avgMessagesPerParticipant,
  s.senderId AS mostActiveParticipantId, CAST(coalesce(h.h, 12) AS INTEGER) AS peakActivityHour,
  k.messageType AS dominantMessageType, round(coalesce(CAST(t.media AS DOUBLE) / t.n, 0), 6) AS mediaShareRate,
  round(coalesce(CAST(t.reactions AS DOUBLE) / t.n, 0), 6) AS reactionRate,
  CASE WHEN idle > 30 THEN 'dead' WHEN idle > 14 THEN 'dying' WHEN coalesce(t.n7, 0) < 3 THEN 'quiet'
    WHEN t.n7 >= 10 THEN 'thriving' ELSE 'active' END AS conversationHealth,
  {YM.format(AS_OF)}
FROM (SELECT b.*, coalesce({AS_OF} - x.last, 999) AS idle FROM b_conversations b
      LEFT JOIN (SELECT conversationId, max(d) AS last FROM s_messages GROUP BY 1) x ON x.conversationId = b._id) c
LEFT JOIN (
  SELECT conversationId, count(*) AS n, count(*) FILTER (WHERE d >= {AS_OF} - 7) AS n7,
    count(*) FILTER (WHERE d >= {AS_OF} - 30) AS n30,
    count(DISTINCT CASE WHEN d >= {AS_OF} - 7 THEN senderId END) AS people7,
    count(*) FILTER (WHERE hasAttachments) AS media, sum(reactionCount) AS reactions
  FROM s_messages GROUP BY 1) t ON t.conversationId = c._id
LEFT JOIN (
  SELECT DISTINCT ON (conversationId) conversationId, senderId
  FROM (SELECT conversationId, senderId, count(*) AS n FROM s_messages GROUP BY 1, 2)
  ORDER BY conversationId, n DESC, senderId) s ON s.conversationId = c._id
LEFT JOIN (
  SELECT DISTINCT ON (conversationId) conversationId, h
  FROM (SELECT conversationId, h, count(*) AS n FROM s_messages GROUP BY 1, 2)
  ORDER BY conversationId, n DESC, h) h ON h.conversationId = c._id
LEFT JOIN (
  SELECT DISTINCT ON (conversationId) conversationId, messageType
  FROM (SELECT conversationId, messageType, count(*) AS n FROM s_messages GROUP BY 1, 2)
  ORDER BY conversationId, n DESC, messageType) k ON k.conversationId = c._id""")


def report(table: str, source: str, checks: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", count(*) FILTER (WHERE {bad}) AS failed, "
        f"count(*) AS total FROM {source}"
        for check, bad in checks.items()
    )


REPEATED = "(SELECT *, row_number() OVER (PARTITION BY _id) > 1 AS again FROM {0})"
add("quality_report", "\nUNION ALL\n".join([
    report("bronze.messages", REPEATED.format("raw_messages"), {
        "null:_id": "_id IS NULL", "null:content": "content IS NULL", "null:replyTo": "replyTo IS NULL",
        "duplicate:_id": "again", "enum:messageType": "messageType NOT IN (''text'', ''image'')".replace("''", "'"),
        "future:createdAt": "CAST(createdAt AS DATE) > DATE '2024-01-20'",
    }),
    report("bronze.users", REPEATED.format("b_users"), {
        "null:_id": "_id IS NULL", "null:email": "email IS NULL", "duplicate:_id": "again",
        "enum:role": "role NOT IN ('BUILDING', 'user')",
        "future:createdAt": f"CAST(createdAt AS DATE) > {AS_OF}",
    }),
    report("bronze.calls", REPEATED.format("b_calls"), {
        "null:_id": "_id IS NULL", "null:duration": "duration IS NULL", "duplicate:_id": "again",
        "enum:status": "status NOT IN ('initiated', 'ongoing', 'ended', 'missed')",
        "enum:callType": "callType NOT IN ('audio', 'video')",
        "future:createdAt": f"CAST(createdAt AS DATE) > {AS_OF}",
    }),
]))


def _content(name: str, table: str, key: str, *measures: str) -> str:
    values = ", ".join(f"round(CAST({m} AS DOUBLE), 6) AS v{i}" for i, m in enumerate(measures))
    return f"SELECT '{table}' AS \"table\", CAST({key} AS VARCHAR) AS key, {values} FROM ({ORACLE[name]})"


CONTENT_SQL = "\nUNION ALL\n".join([
    _content("silver_messages", "silver/messages", "messageId", "contentLength", "reactionCount", "isEdited"),
    _content("daily_metrics", "gold/metrics/daily", "metricDate", "totalMessages", "activeUsers", "avgMessagesPerUser"),
    _content(
        "weekly_metrics", "gold/metrics/weekly", "weekStartDate", "weeklyActiveUsers", "returningUsers",
        "engagementScore",
    ),
    _content(
        "monthly_metrics", "gold/metrics/monthly", "yearMonth", "monthlyActiveUsers", "avgDailyMessages",
        "peakDayOfWeek",
    ),
    _content(
        "user_engagement", "gold/analytics/user_engagement", "userId", "totalMessagesSent",
        "conversationsParticipating", "engagementScore",
    ),
    _content(
        "conversation_analytics", "gold/analytics/conversations", "conversationId", "totalMessages",
        "avgMessagesPerDay", "peakActivityHour",
    ),
    _content("user_features", "gold/ml_features", "userId", "msgSentLast30d", "uniqueContacts", "messageVelocity7d"),
])
for name in ("medallion_run", "merge_existing_lake"):
    ORACLE[name] = CONTENT_SQL
ORACLE["user_activity_incremental"] = ORACLE["user_activity"]


def _with(column: str, *names: str) -> None:
    """Queries that report a property of themselves: it holds for every row."""
    for name in names:
        ORACLE[name] = f"SELECT *, true AS {column} FROM ({ORACLE[name]})"


_with("fewerFiles", "compact_rewrite")
_with("rangesApart", "cluster_rewrite")
_with(
    "agrees", "activity_spine", "message_mix", "peak_hour", "feature_windows", "social_features", "temporal_features",
    "velocity", "churn_label",
)

ORACLE["retention_expiry"] = ORACLE["retention_filter"]
ORACLE["cluster_two_columns"] = f"""
SELECT * EXCLUDE (rangesApart), true AS conversationIdSkips, true AS senderIdSkips FROM ({ORACLE["cluster_rewrite"]})"""
ORACLE["single_jobs"] = ORACLE["medallion_run"]
