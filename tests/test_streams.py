import datetime as dt
import json
import threading

import pytest

from checks.stage import Stage
from palaver import schemas
from palaver.plans import lake
from palaver.sources import readers, tables
from palaver.streaming import ingest, live, sinks


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=minute, seconds=second)


def record(key, minute, sender="u", conversation="c", content="hi", second=0):
    when = at(minute, second)
    body = {"_id": key, "conversationId": conversation, "senderId": sender, "type": "text", "content": content,
            "createdAt": when.isoformat() + "Z", "updatedAt": when.isoformat() + "Z", "unknown": 1}
    return json.dumps(body), when


class Bus:
    def __init__(self, spark, tmp_path):
        self.spark, self.tmp = spark, tmp_path
        self.folder, self.out, self.mark = (str(tmp_path / n) for n in ("bus", "out", "mark"))

    def send(self, records):
        df = self.spark.createDataFrame(records, "value string, timestamp timestamp")
        df.coalesce(1).write.mode("append").parquet(self.folder)

    def values(self):
        return readers.scan_value_files(self.spark, self.folder)

    def read(self):
        return self.spark.read.parquet(self.out)


@pytest.fixture
def bus(spark, tmp_path):
    return Bus(spark, tmp_path)


def ingest_once(bus, parse=ingest.message_stream):
    stream = parse(bus.values())
    sinks.await_all([sinks.append_to_table(stream, bus.out, bus.mark, schemas.DAY_PARTITIONS, every=None)])


def test_ingest_is_lossless_and_once_per_row(bus):
    bus.send([record("a", 0), record("b", 60)])
    ingest_once(bus)
    bus.send([record("late", -6000), ("{broken", at(61)), record("c", 62)])
    ingest_once(bus)
    ingest_once(bus)
    rows = bus.read().collect()
    assert sorted(str(r._id) for r in rows) == ["None", "a", "b", "c", "late"]
    assert set(bus.read().columns) == set(schemas.BRONZE_MESSAGES)
    row = next(r for r in rows if r._id == "a")
    assert (row.messageType, row.isEdited, row.attachments, row.sourceSystem) == ("text", False, [], "kafka")
    assert row.ingestTimestamp == at(0)


def test_events(bus):
    body = {"eventId": "e1", "eventType": "x", "payload": "{\"k\": 1}", "timestamp": "2024-01-01T10:00:00Z"}
    bus.send([(json.dumps(body), at(0))])
    ingest_once(bus, ingest.event_stream)
    row = bus.read().first()
    assert (row.eventId, row.payload, row.timestamp, row.day) == ("e1", '{"k": 1}', at(0), 1)


def test_drop_repeats(bus):
    def run():
        stream = ingest.drop_repeats(ingest.message_stream(bus.values()), ["_id"])
        sinks.await_all([sinks.append_to_table(stream, bus.out, bus.mark, every=None)])

    bus.send([record("a", 0), record("a", 0), record("b", 30)])
    run()
    bus.send([record("b", 30), record("c", 31), record("late", 1)])
    run()
    assert sorted(r._id for r in bus.read().collect()) == ["a", "b", "c"]


LIVE = [
    record("1", 0, "u1", "c1", "abc"), record("2", 0, "u1", "c2", None, 30), record("3", 0, "u2", "c1", "a", 59),
    record("4", 1, "u3", "c1", "abcd"), record("5", 40, "u3", "c1"),
]


def merged(bus, stream, keys):
    sinks.await_all([sinks.merge_updates(stream, bus.out, bus.mark, keys, live.WINDOW_PARTITIONS, every=None)])


def test_live_metrics_exact_report_every_window(bus):
    def run():
        merged(bus, live.live_members(bus.values()), live.MEMBER_KEYS)
        return {r.windowStart: r for r in live.live_metrics_exact(bus.read()).collect()}

    bus.send(LIVE)
    got = run()
    assert set(got) == {at(0), at(1), at(40)}
    bus.send([record("6", 40, "u9", "c1", "x", 5), record("7", 40, None, None, "yyy", 6)])
    last = run()[at(40)]
    assert (last.messageCount, last.activeUsers, last.activeConversations, last.avgMessageLength) == (3, 2, 1, 2.0)
    first = run()[at(0)]
    assert (first.messageCount, first.activeUsers, first.activeConversations, first.avgMessageLength) == (3, 2, 2, 2.0)


def test_live_metrics_update_mode_keeps_the_latest_value(bus):
    bus.send(LIVE)
    merged(bus, live.live_metrics(bus.values()), ["windowStart"])
    bus.send([record("6", 40, "u9", "c1", "x", 5)])
    merged(bus, live.live_metrics(bus.values()), ["windowStart"])
    got = {r.windowStart: r for r in bus.read().collect()}
    assert len(got) == 3
    assert (got[at(0)].messageCount, got[at(0)].activeUsers, got[at(40)].messageCount) == (3, 2, 2)


def test_batch_and_stream_share_a_table(spark, bus):
    spec = lake.TABLES["bronze/messages"]
    when = "TIMESTAMP '2024-01-01 10:00:00'"
    values = {"_id": "'a'", "content": "'batch'", "createdAt": when, "updatedAt": when, "year": "2024", "month": "1",
              "day": "1"}
    batch = spark.range(1).selectExpr(*[
        f"CAST({values.get(c, 'NULL')} AS {t}) AS {c}" for c, t in schemas.BRONZE_MESSAGES.items()
    ])
    tables.upsert_partitions(spark, batch, bus.out, spec.keys, spec.partition_by)

    def run():
        sinks.await_all([sinks.merge_updates(
            ingest.message_stream(bus.values()), bus.out, bus.mark, spec.keys, spec.partition_by, "append", None,
            spec.version, spec.tie_break,
        )])
        return sorted((str(r._id), r.content) for r in spark.read.parquet(bus.out).select("_id", "content").collect())

    bus.send([record("b", 1), ("{broken", at(2)), ("{broken too", at(3))])
    assert run() == [("None", None), ("None", None), ("a", "batch"), ("b", "hi")]
    bus.send([record("a", 5, content="edit"), record("b", -60, content="older")])  # an edit, and a version that is older
    assert run() == [("None", None), ("None", None), ("a", "edit"), ("b", "hi")]
    assert run() == [("None", None), ("None", None), ("a", "edit"), ("b", "hi")]


def test_rows_without_a_key_are_no_repeats(bus):
    bus.send([record("a", 0), ("{broken", at(1)), ("{x", at(1)), ("{y", at(2)), record("a", 0)])
    stream = ingest.drop_repeats(ingest.message_stream(bus.values()), ["_id"])
    sinks.await_all([sinks.append_to_table(stream, bus.out, bus.mark, every=None)])
    assert sorted(str(r._id) for r in bus.read().collect()) == ["None", "None", "None", "a"]


def test_interval_queries_end_together(spark, bus):
    bus.send([record("a", 0)])
    spark.streams.resetTerminated()  # queries of earlier tests have ended
    query = sinks.append_to_table(ingest.message_stream(bus.values()), bus.out, bus.mark, every="1 second")
    threading.Timer(6, query.stop).start()
    sinks.await_any(spark)
    assert not query.isActive
    spark.streams.resetTerminated()
    assert bus.read().count() == 1


def test_final_live_metrics_report_closed_windows_once(bus):
    def run():
        sinks.await_all([sinks.append_to_table(
            live.live_metrics_final(bus.values()), bus.out, bus.mark, live.WINDOW_PARTITIONS, every=None
        )])
        rows = bus.read().collect()
        got = {r.windowStart: (r.messageCount, r.activeUsers, r.activeConversations, r.avgMessageLength) for r in rows}
        assert len(got) == len(rows)
        return got

    bus.send(LIVE)
    bus.send([record("6", 1, None, None, "yy", 6)])
    first = run()
    assert first == {at(0): (3, 2, 2, 2.0), at(1): (2, 1, 1, 3.0)}  # the window at 40 minutes is open
    bus.send([record("late", 0, "u9", "c9"), record("7", 40, "u4", "c1", "x", 5), record("8", 59, "u4", "c1")])
    second = run()
    assert second == first | {at(40): (2, 2, 1, 1.5)}


def test_stream_files_are_written_with_the_codec_of_tables(bus):
    bus.send([record("a", 0), record("b", 1)])
    ingest_once(bus)
    changed = str(bus.tmp / "changed")
    sinks.await_all([sinks.add_changes(ingest.message_stream(bus.values()), changed, str(bus.tmp / "m2"), every=None)])
    for folder in ("out", "changed.changes"):
        files = list((bus.tmp / folder).rglob("*.parquet"))
        assert files and all(f".{tables.CODEC}." in f.name for f in files)


def test_bus_records_are_written_where_they_are_made(spark, tmp_path):
    """Four tasks make the records and four write them, by halves of the month: there is no shuffle between."""
    made = spark.range(0, 40, 1, 4).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(CAST(id % 2 * 20 AS INT)) AS ts", "id AS user_id",
        "'click' AS event_type", "CAST(id AS DOUBLE) AS value", "'{\"k\": 1}' AS props",
    )
    made.write.parquet(str(tmp_path / "events.parquet"))
    layers = Stage(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        early, late = (layers.bus_values("events", half) for half in (True, False))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {json.loads(r.value)["eventId"] for r in early.collect()} == {str(i) for i in range(0, 40, 2)}
    assert early.count() + late.count() == 40
    assert len(early.inputFiles()) == 4
