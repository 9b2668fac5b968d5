"""Bronze layer: source documents with flat ids, filled defaults and ingestion metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.arrays import or_empty
from palaver.functions.columns import fill_defaults, time_parts, with_ingestion
from palaver.operators.dedup import deduplicate
from palaver.operators.enrich import lookup
from palaver.sources.readers import auth_accounts


def _land(df: DataFrame, source_system: str, arrays: dict[str, str], defaults: dict) -> DataFrame:
    """What all four entities share. ``_id`` may be a document id struct or already a string."""
    identity = F.col("_id.oid") if df.schema["_id"].dataType.typeName() == "struct" else F.col("_id")
    flat = df.withColumns({"_id": identity.cast("string"), **{n: or_empty(F.col(n), t) for n, t in arrays.items()}})
    stamped = with_ingestion(fill_defaults(flat, defaults), source_system)
    parts = time_parts("createdAt")
    return stamped.withColumns({p: parts[p] for p in schemas.DAY_PARTITIONS})


def bronze_messages(raw: DataFrame, source_system: str = "mongodb") -> DataFrame:
    arrays = {"attachments": schemas.ATTACHMENTS, "reactions": schemas.REACTIONS, "readBy": schemas.STRINGS}
    flags = {"isEdited": False, "isDeleted": False, "isForwarded": False}
    landed = _land(raw.withColumnRenamed("type", "messageType"), source_system, arrays, flags)
    return schemas.conform(landed, schemas.BRONZE_MESSAGES)


def login_accounts(auth: DataFrame) -> DataFrame:
    """One account per email: of several, the one with the latest login."""
    return deduplicate(
        auth_accounts(auth).filter(F.col("authEmail").isNotNull()), ["authEmail"], "lastLoginAt",
        tie_break=["authUserId"],
    ).drop("authUserId", "authCreatedAt")


def bronze_users(raw: DataFrame, accounts: DataFrame) -> DataFrame:
    """Latest user documents with their login account, matched on email: one row per user.

    ``accounts`` are the written ``login_accounts``: on a written table, adaptive execution can split the users of a
    shared email. Users without an email go past the join. Users are looked up by message jobs, where a second row would
    multiply every message of that sender.
    """
    defaults = {"isOnline": False, "role": "user", "isBanned": False, "isVerified": False}
    landed = _land(raw, "mongodb+mysql", {}, defaults)
    latest = deduplicate(landed, ["_id"], "updatedAt", tie_break=["createdAt", "email"])
    joined = lookup(latest.filter(F.col("email").isNotNull()), "email", accounts, "authEmail")
    alone = latest.filter(F.col("email").isNull())
    return schemas.conform(joined.unionByName(alone, allowMissingColumns=True), schemas.BRONZE_USERS)


def bronze_conversations(raw: DataFrame) -> DataFrame:
    arrays = {"participants": schemas.STRINGS, "admins": schemas.STRINGS}
    flags = {"isArchived": False, "isLocked": False}
    landed = _land(raw.withColumnRenamed("type", "conversationType"), "mongodb", arrays, flags)
    return schemas.conform(landed, schemas.BRONZE_CONVERSATIONS)


def bronze_calls(raw: DataFrame) -> DataFrame:
    landed = _land(raw.withColumnRenamed("type", "callType"), "mongodb", {"participantIds": schemas.STRINGS}, {})
    return schemas.conform(landed, schemas.BRONZE_CALLS)
