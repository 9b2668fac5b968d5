"""Two-pass external shuffle into shards of equal row counts, with DataFrame functions only.

Pass one scatters rows by a seeded hash over buckets that fit in memory. Pass two puts each bucket's rows into an array in
a fixed order, shuffles it (``shuffle`` is Fisher-Yates, with a seed) and lays the buckets end to end: a uniform
permutation of all rows. Position ``p`` goes to shard ``p % shards`` at slot ``p // shards``, so counts differ by at most
one. Buckets are counted from a scan of keys alone; no row moves more than once.

The number of buckets follows from the number of bytes. The hash covers the row's key and text, so a third of all rows
with one text, or with one key, still scatter; only rows equal in both meet in one bucket.

Defined results: a null text counts as no bytes; rows with a null key are shuffled like others. An empty table gives no
shards. Columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import table, without, written

SEED = 29
BUCKET_BYTES = 32 << 20
# Rows alone take memory too.
ROW_BYTES = 200


def shuffled(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED,
             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows with ``shard`` and ``slot``."""
    docs = without(docs, ["shard", "slot"])
    size = F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = int(max(1, -(-total // bucket_bytes)))
    bucket = F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit(seed)), F.lit(buckets)).cast("int")
    counts = docs.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    # One row for each bucket: where its first row stands among all.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "buckets")
    order = F.xxhash64(F.col(key), F.col(text), F.lit(seed + 1))
    row = F.struct(order.alias("_order"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    full = (
        docs.select(bucket.alias("bucket"), row.alias("_item")).repartition(buckets, "bucket")
        .groupBy("bucket").agg(F.collect_list("_item").alias("_items"))
    )
    # One number for each bucket is broadcast: 16 bytes for every BUCKET_BYTES of text.
    # Sorted, so that the shuffle's random numbers meet the buckets in the same order whenever a task is repeated.
    mixed = full.join(F.broadcast(starts), "bucket").sortWithinPartitions("bucket").select(
        "start", F.shuffle(F.array_sort("_items"), seed).alias("_mixed")
    ).select("start", F.posexplode("_mixed").alias("_at", "_item"))
    position = F.col("start") + F.col("_at")
    return mixed.select(
        "_item._row.*", (position % shards).cast("int").alias("shard"),
        F.floor(position / F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Write the shuffled rows as one directory for each shard, each file in slot order."""
    rows = shuffled(docs, shards, **options)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_sharding(spark, sf_dir: str, shards: int = 8) -> DataFrame:
    """Shard and slot of every document, with equal row counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return shuffled(docs, shards).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
