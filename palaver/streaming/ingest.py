"""Bus values to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.columns import with_time_parts

WATERMARK = "10 minutes"
SOURCE_SYSTEM = "kafka"


def parse_values(values: DataFrame, contract: schemas.Contract, *more: Column) -> DataFrame:
    """JSON documents as columns, beside the bus timestamp and ``more`` columns made of the raw rows.

    Malformed documents give null columns, unknown fields are ignored; no row is lost.
    """
    parsed = F.from_json(F.col("value").cast("string"), schemas.ddl(contract)).alias("data")
    raw = F.struct(F.col("timestamp").alias("busTimestamp"), *more).alias("raw")
    return values.select(parsed, raw).select("data.*", "raw.*")


def _stamp(df: DataFrame, event_time: str, watermark: str) -> DataFrame:
    stamped = df.withColumns({"ingestTimestamp": F.col("busTimestamp"), "sourceSystem": F.lit(SOURCE_SYSTEM)})
    return with_time_parts(stamped, event_time).withWatermark(event_time, watermark)


def message_stream(values: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Messages in the layout of the bronze table, so that stream and batch rows share it.

    Fields the bus does not carry are null (sizes, thumbnails, reaction times, expiry) or empty (readers).
    """
    parsed = parse_values(values, schemas.STREAM_MESSAGES).withColumnRenamed("type", "messageType")

    def attachment(a):
        none = F.lit(None)
        return F.struct(
            a["type"].alias("type"), a["url"].alias("url"), a["filename"].alias("filename"),
            none.cast("bigint").alias("size"), none.cast("string").alias("mimeType"),
            none.cast("string").alias("thumbnailUrl"),
        )

    def reaction(r):
        return F.struct(
            r["userId"].alias("userId"), r["emoji"].alias("emoji"),
            F.lit(None).cast("timestamp").alias("createdAt"),
        )

    flags = {f: F.coalesce(f, F.lit(False)) for f in ("isEdited", "isDeleted", "isForwarded")}
    widened = parsed.withColumns({
        "attachments": F.coalesce(F.transform("attachments", attachment), F.array().cast(schemas.ATTACHMENTS)),
        "reactions": F.coalesce(F.transform("reactions", reaction), F.array().cast(schemas.REACTIONS)),
        "readBy": F.array().cast(schemas.STRINGS),
        "expiresAt": F.lit(None).cast("timestamp"),
        **flags,
    })
    return _stamp(widened, "createdAt", watermark).select(*schemas.BRONZE_MESSAGES)


def event_stream(values: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    parsed = parse_values(values, schemas.STREAM_EVENTS)
    return _stamp(parsed, "timestamp", watermark).select(*schemas.BRONZE_EVENTS)


def drop_repeats(stream: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key within the watermark delay. State is bounded by the watermark; rows older than it are dropped.

    Rows without a key (malformed documents) are no repeats of each other: they pass by.
    """
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    return stream.filter(keyed).dropDuplicatesWithinWatermark(keys).unionByName(stream.filter(~keyed))
