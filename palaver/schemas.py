"""Table contracts: column name -> Spark type, in output order.

``ddl`` turns a contract into the schema string readers and ``from_json`` take; ``conform`` projects a frame onto one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Contract = dict[str, str]

OBJECT_ID = "struct<oid:string>"
ATTACHMENTS = "array<struct<type:string,url:string,filename:string,size:bigint,mimeType:string,thumbnailUrl:string>>"
REACTIONS = "array<struct<userId:string,emoji:string,createdAt:timestamp>>"
STRINGS = "array<string>"

RAW_MESSAGES: Contract = {
    "_id": OBJECT_ID, "conversationId": "string", "senderId": "string", "type": "string", "content": "string",
    "attachments": ATTACHMENTS, "reactions": REACTIONS, "replyTo": "string", "isEdited": "boolean",
    "isDeleted": "boolean", "isForwarded": "boolean", "readBy": STRINGS, "createdAt": "timestamp",
    "updatedAt": "timestamp", "expiresAt": "timestamp",
}
RAW_USERS: Contract = {
    "_id": OBJECT_ID, "phoneNumber": "string", "email": "string", "username": "string", "displayName": "string",
    "avatar": "string", "bio": "string", "status": "string", "lastSeen": "timestamp", "isOnline": "boolean",
    "role": "string", "isBanned": "boolean", "isVerified": "boolean", "createdAt": "timestamp",
    "updatedAt": "timestamp",
}
RAW_AUTH: Contract = {
    "id": "bigint", "email": "string", "email_verified": "boolean", "two_factor_enabled": "boolean",
    "last_login_at": "timestamp", "login_count": "bigint", "created_at": "timestamp",
}
RAW_CONVERSATIONS: Contract = {
    "_id": OBJECT_ID, "type": "string", "name": "string", "avatar": "string", "participants": STRINGS,
    "admins": STRINGS, "lastMessageId": "string", "lastMessageAt": "timestamp", "isArchived": "boolean",
    "isLocked": "boolean", "createdBy": "string", "createdAt": "timestamp", "updatedAt": "timestamp",
}
RAW_CALLS: Contract = {
    "_id": OBJECT_ID, "initiatorId": "string", "participantIds": STRINGS, "conversationId": "string",
    "type": "string", "status": "string", "startTime": "timestamp", "endTime": "timestamp", "duration": "bigint",
    "createdAt": "timestamp",
}

# JSON documents carried in the ``value`` field of the message bus.
STREAM_MESSAGES: Contract = {
    "_id": "string", "conversationId": "string", "senderId": "string", "type": "string", "content": "string",
    "attachments": "array<struct<type:string,url:string,filename:string>>",
    "reactions": "array<struct<userId:string,emoji:string>>", "replyTo": "string", "isEdited": "boolean",
    "isDeleted": "boolean", "isForwarded": "boolean", "createdAt": "timestamp", "updatedAt": "timestamp",
}
STREAM_EVENTS: Contract = {
    "eventId": "string", "eventType": "string", "entityType": "string", "entityId": "string", "userId": "string",
    "payload": "string", "timestamp": "timestamp",
}

_INGESTED: Contract = {"ingestTimestamp": "timestamp", "sourceSystem": "string"}
_BY_DAY: Contract = {"year": "int", "month": "int", "day": "int"}
_BY_MONTH: Contract = {"year": "int", "month": "int"}

BRONZE_MESSAGES: Contract = {
    "_id": "string", "conversationId": "string", "senderId": "string", "messageType": "string", "content": "string",
    "attachments": ATTACHMENTS, "reactions": REACTIONS, "replyTo": "string", "isEdited": "boolean",
    "isDeleted": "boolean", "isForwarded": "boolean", "readBy": STRINGS, "createdAt": "timestamp",
    "updatedAt": "timestamp", "expiresAt": "timestamp", **_INGESTED, **_BY_DAY,
}
BRONZE_USERS: Contract = {
    "_id": "string", "phoneNumber": "string", "email": "string", "username": "string", "displayName": "string",
    "avatar": "string", "bio": "string", "status": "string", "lastSeen": "timestamp", "isOnline": "boolean",
    "role": "string", "isBanned": "boolean", "isVerified": "boolean", "emailVerified": "boolean",
    "twoFactorEnabled": "boolean", "lastLoginAt": "timestamp", "loginCount": "bigint", "createdAt": "timestamp",
    "updatedAt": "timestamp", **_INGESTED, **_BY_MONTH,
}
BRONZE_CONVERSATIONS: Contract = {
    "_id": "string", "conversationType": "string", "name": "string", "avatar": "string", "participants": STRINGS,
    "admins": STRINGS, "lastMessageId": "string", "lastMessageAt": "timestamp", "isArchived": "boolean",
    "isLocked": "boolean", "createdBy": "string", "createdAt": "timestamp", "updatedAt": "timestamp",
    **_INGESTED, **_BY_MONTH,
}
BRONZE_CALLS: Contract = {
    "_id": "string", "initiatorId": "string", "participantIds": STRINGS, "conversationId": "string",
    "callType": "string", "status": "string", "startTime": "timestamp", "endTime": "timestamp",
    "duration": "bigint", "createdAt": "timestamp", **_INGESTED, **_BY_DAY,
}
BRONZE_EVENTS: Contract = {**STREAM_EVENTS, **_INGESTED, **_BY_DAY}

SILVER_MESSAGES: Contract = {
    "messageId": "string", "conversationId": "string", "senderId": "string", "senderName": "string",
    "messageType": "string", "content": "string", "contentLength": "int", "hasAttachments": "boolean",
    "attachmentCount": "int", "attachmentTypes": STRINGS, "reactionCount": "int", "uniqueReactors": "int",
    "isReply": "boolean", "replyToMessageId": "string", "isEdited": "boolean", "isDeleted": "boolean",
    "isForwarded": "boolean", "readCount": "int", "createdAt": "timestamp", "updatedAt": "timestamp", **_BY_DAY,
    "hour": "int", "dayOfWeek": "int", "isWeekend": "boolean", "processedAt": "timestamp",
}
SILVER_USERS: Contract = {
    "userId": "string", "phoneNumber": "string", "email": "string", "username": "string", "displayName": "string",
    "hasAvatar": "boolean", "hasBio": "boolean", "status": "string", "lastSeen": "timestamp",
    "lastSeenDaysAgo": "int", "isOnline": "boolean", "role": "string", "isBanned": "boolean",
    "isVerified": "boolean", "accountAgeDays": "int", "createdAt": "timestamp", "updatedAt": "timestamp",
    **_BY_MONTH, "processedAt": "timestamp",
}
SILVER_CONVERSATIONS: Contract = {
    "conversationId": "string", "conversationType": "string", "name": "string", "hasAvatar": "boolean",
    "participantCount": "int", "adminCount": "int", "hasLastMessage": "boolean", "lastMessageAt": "timestamp",
    "daysSinceLastMessage": "int", "isArchived": "boolean", "isLocked": "boolean", "isActive": "boolean",
    "createdBy": "string", "createdAt": "timestamp", "updatedAt": "timestamp", "conversationAgeDays": "int",
    **_BY_MONTH, "processedAt": "timestamp",
}
SILVER_CALLS: Contract = {
    "callId": "string", "initiatorId": "string", "participantCount": "int", "conversationId": "string",
    "callType": "string", "status": "string", "isCompleted": "boolean", "isMissed": "boolean",
    "startTime": "timestamp", "endTime": "timestamp", "durationSeconds": "bigint", "durationMinutes": "double",
    "durationCategory": "string", "createdAt": "timestamp", **_BY_DAY, "hour": "int", "processedAt": "timestamp",
}
FIRST_CONTACTS: Contract = {"userId": "string", "conversationId": "string", "firstDay": "date", **_BY_DAY}

USER_ACTIVITY: Contract = {
    "userId": "string", "activityDate": "date", "messagesSent": "bigint", "messagesReceived": "bigint",
    "reactionsGiven": "bigint", "reactionsReceived": "bigint", "callsInitiated": "bigint",
    "callsReceived": "bigint", "totalCallDurationMinutes": "double", "conversationsActive": "bigint",
    "newConversationsStarted": "bigint", "mediaShared": "bigint", "isActiveDay": "boolean", **_BY_DAY,
    "dayOfWeek": "int", "processedAt": "timestamp",
}
TOTAL_WINDOWS = (7, 30)
TOTAL_MEASURES = (
    "messagesSent", "messagesReceived", "reactionsGiven", "reactionsReceived", "callsInitiated", "callsReceived",
)
USER_TOTALS: Contract = {
    "userId": "string", "asOf": "date", "lastActiveDate": "date",
    **{f"{m}{span}": "bigint" for m in (*TOTAL_MEASURES, "callSeconds", "activeDays", "days")
       for span in (*[f"Last{w}" for w in TOTAL_WINDOWS], "Total")},
}
DAY_STATES: Contract = {
    "metricDate": "date", "activeUsers": "bigint", "avgMessagesPerUser": "double", "totalMessages": "bigint",
    "textMessages": "bigint", "mediaMessages": "bigint", "totalReactions": "bigint", "peakHour": "int",
    "activeConversations": "bigint", "messageTypes": "map<string,bigint>", "totalCalls": "bigint", "audioCalls": "bigint",
    "videoCalls": "bigint", "totalCallDurationMinutes": "double", "avgCallDurationMinutes": "double", "year": "int",
    "month": "int",
}
DAILY_METRICS: Contract = {
    "metricDate": "date", "totalUsers": "bigint", "activeUsers": "bigint", "newUsers": "bigint",
    "totalMessages": "bigint", "textMessages": "bigint", "mediaMessages": "bigint", "totalCalls": "bigint",
    "audioCalls": "bigint", "videoCalls": "bigint", "totalCallDurationMinutes": "double",
    "avgCallDurationMinutes": "double", "totalConversations": "bigint", "activeConversations": "bigint",
    "newConversations": "bigint", "totalReactions": "bigint", "avgMessagesPerUser": "double",
    "avgSessionsPerUser": "double", "peakHour": "int", **_BY_DAY, "dayOfWeek": "int", "isWeekend": "boolean",
    "processedAt": "timestamp",
}
USER_ENGAGEMENT: Contract = {
    "userId": "string", "calculationDate": "date", "totalMessagesSent": "bigint",
    "totalMessagesReceived": "bigint", "totalReactionsGiven": "bigint", "totalReactionsReceived": "bigint",
    "totalCallsInitiated": "bigint", "totalCallsReceived": "bigint", "totalCallDurationMinutes": "double",
    "activeDaysLast7": "bigint", "activeDaysLast30": "bigint", "avgDailyMessages": "double",
    "avgResponseTimeMinutes": "double", "uniqueContactsMessaged": "bigint", "conversationsParticipating": "bigint",
    "groupsParticipating": "bigint", "engagementScore": "double", "activityTrend": "string", "churnRisk": "string",
    "userSegment": "string", **_BY_MONTH, "processedAt": "timestamp",
}
USER_FEATURES: Contract = {
    "userId": "string", "featureDate": "date", "msgSentLast1d": "bigint", "msgSentLast7d": "bigint",
    "msgSentLast30d": "bigint", "msgRecvLast1d": "bigint", "msgRecvLast7d": "bigint", "msgRecvLast30d": "bigint",
    "activeDaysLast7d": "bigint", "activeDaysLast30d": "bigint", "avgSessionDurationMinutes": "double",
    "uniqueContacts": "bigint", "groupCount": "bigint", "avgGroupSize": "double", "preferredHour": "int",
    "weekdayActivityRatio": "double", "messageVelocity7d": "double", "engagementTrend": "double",
    "willChurnNext7d": "boolean", "processedAt": "timestamp",
}
WEEKLY_METRICS: Contract = {
    "weekStartDate": "date", "weekEndDate": "date", "weekNumber": "int", "totalUsers": "bigint",
    "weeklyActiveUsers": "bigint", "newUsers": "bigint", "returningUsers": "bigint", "churnedUsers": "bigint",
    "retentionRate": "double", "totalMessages": "bigint", "avgDailyMessages": "double", "totalCalls": "bigint",
    "avgDailyActiveCalls": "double", "totalCallDurationHours": "double", "engagementScore": "double",
    "year": "int", "processedAt": "timestamp",
}
MONTHLY_METRICS: Contract = {
    "monthDate": "date", "yearMonth": "string", "totalUsers": "bigint", "monthlyActiveUsers": "bigint",
    "newUsers": "bigint", "churnedUsers": "bigint", "retentionRate": "double", "dauMauRatio": "double",
    "totalMessages": "bigint", "avgDailyMessages": "double", "totalCalls": "bigint",
    "totalCallDurationHours": "double", "avgMessagesPerActiveUser": "double",
    "topMessageTypes": "map<string,bigint>", "peakDayOfWeek": "int", **_BY_MONTH, "processedAt": "timestamp",
}
CONVERSATION_ANALYTICS: Contract = {
    "conversationId": "string", "calculationDate": "date", "conversationType": "string", "participantCount": "int",
    "totalMessages": "bigint", "totalMessagesLast7Days": "bigint", "totalMessagesLast30Days": "bigint",
    "uniqueParticipantsLast7Days": "int", "avgMessagesPerDay": "double", "avgMessagesPerParticipant": "double",
    "mostActiveParticipantId": "string", "peakActivityHour": "int", "dominantMessageType": "string",
    "mediaShareRate": "double", "reactionRate": "double", "conversationHealth": "string", **_BY_MONTH,
    "processedAt": "timestamp",
}

# The enumerations of the data model.
QUALITY_REPORT: Contract = {"table": "string", "check": "string", "failed": "bigint", "total": "bigint"}

MESSAGE_TYPES = ("text", "image", "video", "audio", "file", "call", "system")
MEDIA_TYPES = ("image", "video", "audio", "file")
CONVERSATION_TYPES = ("single", "group")
CALL_TYPES = ("audio", "video")
CALL_STATUSES = ("initiated", "ongoing", "ended", "missed")

DAY_PARTITIONS = ("year", "month", "day")
MONTH_PARTITIONS = ("year", "month")


def ddl(contract: Contract) -> str:
    return ", ".join(f"`{name}` {dtype}" for name, dtype in contract.items())


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Project onto the contract's columns, order and types; a missing column is an analysis error."""
    return df.select(*[F.col(name).cast(dtype).alias(name) for name, dtype in contract.items()])
