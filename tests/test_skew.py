"""One key holds a third of all rows: joins split it, directories spread over tasks, results stay whole."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from palaver import schemas
from palaver.operators import enrich
from palaver.plans import bronze, engagement, silver
from palaver.plans.lake import Lake
from palaver.sources import fixtures, tables

ROWS = 30_000


@contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in settings:
            spark.conf.unset(k)


def small_skew_limits(spark):
    """Limits that make a toy table count as skewed."""
    return conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_messages(spark, path):
    """Bronze messages in 16 files, a third of the rows by one sender and on one day."""
    base = {
        "_id": "named_struct('oid', CAST(id AS STRING))", "conversationId": "CAST(id % 50 AS STRING)",
        "senderId": "IF(id % 3 = 0, '7', CAST(id % 1000 AS STRING))", "type": "'text'",
        "content": "repeat(sha2(CAST(id AS STRING), 256), 2)",
        "createdAt": "TIMESTAMP '2024-01-01' + make_dt_interval(IF(id % 3 = 0, 0, CAST(id % 9 AS INT)))",
        "updatedAt": "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id % 9 AS INT))",
    }
    raw = spark.range(0, ROWS, 1, 16).selectExpr(*[
        f"CAST({base.get(c, 'NULL')} AS {t}) AS {c}" for c, t in schemas.RAW_MESSAGES.items()
    ])
    tables.replace_table(bronze.bronze_messages(raw), path)
    return tables.read_table(spark, path, schemas.BRONZE_MESSAGES)


def test_sender_lookup_splits_the_hot_sender(spark, tmp_path):
    messages = hot_messages(spark, str(tmp_path / "b"))
    users = spark.range(1000).selectExpr("CAST(id AS STRING) AS _id", "'n' || id AS displayName")
    with small_skew_limits(spark):
        named = silver.silver_messages(messages, users)
        rows = named.select("senderId", "senderName", "content", "messageId").collect()
        again = silver.silver_messages(messages, users)
        again.collect()
        assert "SortMergeJoin(skew=true)" in final_plan(again)
    assert len(rows) == ROWS and all(r.senderName == "n" + r.senderId for r in rows)


def test_texts_are_not_shuffled_by_sender(spark, tmp_path):
    """The contents pass one exchange, by message, and the name is that of the version that stays."""
    messages = hot_messages(spark, str(tmp_path / "b"))
    edited = messages.filter("_id IN ('5', '6')").withColumns({
        "senderId": F.lit("12"), "updatedAt": F.col("updatedAt") + F.expr("INTERVAL 1 DAY"),
    })
    tables.replace_table(messages.unionByName(edited).unionByName(edited), str(tmp_path / "c"))
    users = spark.range(500).selectExpr("CAST(id AS STRING) AS _id", "'n' || id AS displayName")
    with conf(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
    ):
        named = silver.silver_messages(tables.read_table(spark, str(tmp_path / "c"), schemas.BRONZE_MESSAGES), users)
        text = named._jdf.queryExecution().executedPlan().toString()
        lines = text.splitlines()
        exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line]
        wide = [lines[i] for i in exchanges if any("content#" in line for line in lines[i + 1 : i + 4])]
        assert len(wide) == 1 and "_id#" in wide[0]
        rows = {r.messageId: (r.senderId, r.senderName) for r in named.collect()}
    assert len(rows) == ROWS and rows["5"] == rows["6"] == ("12", "n12")
    assert all(name == ("n" + sender if int(sender) < 500 else None) for sender, name in rows.values())


def test_null_and_hot_emails_spread_over_partitions(spark):
    left = spark.range(20_000).selectExpr(
        "CAST(id AS STRING) AS _id", "CASE id % 3 WHEN 0 THEN 'a' || id WHEN 1 THEN 'a0' END AS email"
    )
    right = spark.range(20_000).selectExpr("'a' || id AS mail", "id AS n")
    with conf(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="32",
    ):
        joined = enrich.lookup_spread(left, "email", "_id", right, "mail")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.filter("n IS NOT NULL").count() == 6_667 + 6_667
    assert sum(sizes) == 20_000 and max(sizes) < 4_000


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    messages, out = hot_messages(spark, str(tmp_path / "b")), tmp_path / "out"
    with conf(
        spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB", spark__sql__files__maxPartitionBytes="100KB",
        spark__sql__files__openCostInBytes="1",
    ):
        assert tables.replace_table(messages, str(out), schemas.DAY_PARTITIONS) == ROWS
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (out / "year=2024" / "month=1").glob("day=*")}
    assert files["day=1"] > 1 and max(n for d, n in files.items() if d != "day=1") <= 2


def test_distinct_counts_send_pairs_not_rows(spark, tmp_path):
    """Conversations per sender: the first shuffle already carries distinct (sender, conversation) pairs."""
    messages = silver.latest_messages(hot_messages(spark, str(tmp_path / "b")))
    tables.replace_table(messages, str(tmp_path / "s"))
    sized = engagement.network_size(engagement.contact_pairs(spark.read.parquet(str(tmp_path / "s"))))
    rows = {r.userId: r.conversationsParticipating for r in sized.collect()}
    assert rows["7"] == 50
    text = final_plan(engagement.network_size(engagement.contact_pairs(spark.read.parquet(str(tmp_path / "s")))))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert "conversationId" in exchanges[-1] and "conversationId" not in exchanges[0]
    below = text[text.rindex("Exchange hashpartitioning("):]
    assert "HashAggregate(keys=" in below and "conversationId" in below.split("HashAggregate(keys=")[1].splitlines()[0]


@pytest.mark.parametrize("name", ["bronze/messages", "silver/messages"])
def test_a_first_load_writes_messages_without_a_shuffle_by_day(spark, tmp_path, name):
    """Each file holds rows of one task of the given frame; a hot day has a file of every task that has rows of it."""
    messages = hot_messages(spark, str(tmp_path / "b"))
    df = messages if name == "bronze/messages" else silver.silver_messages(
        messages, spark.range(1000).selectExpr("CAST(id AS STRING) AS _id", "'n' || id AS displayName")
    )
    lake = Lake(spark, str(tmp_path / "lake"))
    task = F.concat(F.lit("task "), F.spark_partition_id())
    with conf(
        spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="4",
        spark__sql__files__maxPartitionBytes="100KB", spark__sql__files__openCostInBytes="1",
    ):
        rows = lake.upsert(name, df.withColumn("messageType", task))
    assert lake.rows[name] == rows.count() == ROWS
    files = rows.groupBy(F.input_file_name().alias("file"), "day").agg(F.count_distinct("messageType").alias("tasks")).collect()
    assert {r.tasks for r in files} == {1}
    assert len([r for r in files if r.day == 1]) == rows.select("messageType").distinct().count() > 1


def test_a_merge_writes_messages_without_a_shuffle_by_day(spark, tmp_path):
    """New rows and rows that stay lie in files of one task each."""
    messages, lake = hot_messages(spark, str(tmp_path / "b")), Lake(spark, str(tmp_path / "lake"))
    task, late = F.concat_ws(" ", F.lit("task"), "messageType", F.spark_partition_id()), F.col("_id").cast("int") % 2 == 0
    with conf(
        spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="4",
        spark__sql__files__maxPartitionBytes="100KB", spark__sql__files__openCostInBytes="1",
    ):
        lake.upsert("bronze/messages", messages.filter(~late).withColumn("messageType", F.lit("old")))
        merged = messages.filter(late | (F.col("_id") < "2")).withColumn("messageType", F.lit("new"))
        tables.upsert_partitions(
            spark, merged.withColumn("messageType", task), f"{tmp_path}/lake/bronze/messages", ["_id"],
            schemas.DAY_PARTITIONS, placed=True,
        )
        rows = lake.upsert("bronze/messages", merged.limit(0))
    found = rows.groupBy(F.input_file_name().alias("file"), "day").agg(F.count_distinct("messageType").alias("tasks")).collect()
    assert {r.tasks for r in found} == {1} and len([r for r in found if r.day == 1]) > 2
    counts = {r.messageType[:4]: r["count"] for r in rows.groupBy("messageType").count().collect()}
    assert rows.count() == ROWS and set(counts) == {"old", "task"}


def test_events_of_one_file_become_messages_in_several_tasks(spark, tmp_path):
    spark.range(0, 20_000, 1, 1).selectExpr(
        "id AS event_id", "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id % 30 AS INT)) AS ts", "id % 100 AS user_id",
        "'click' AS event_type", "1.0D AS value", "'{\"k\":' || id % 100 || '}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    with conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="4"):
        events = fixtures.shaped_events(spark, str(tmp_path))
        sizes = [r["count"] for r in events.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 24_000 and len(sizes) > 1 and max(sizes) < 20_000
