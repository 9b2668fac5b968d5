import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palaver.operators import dedup, enrich, history, incremental, layout, merge, quality, retention, running
from palaver.sources import readers, tables
from palaver.sources.files import Files


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deduplicate_latest_earliest_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "q")], "k string, t int, v string")
    assert rows(dedup.deduplicate(df, ["k"], "t", tie_break=["v"])) == [("a", 2, "z"), ("b", 5, "q")]
    assert rows(dedup.deduplicate(df, ["k"], "t", descending=False)) == [("a", 1, "x"), ("b", 5, "q")]


def test_deduplicate_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS t").repartition(4)
    text = plan(dedup.deduplicate(df, ["k"], "t"))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_merge_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    assert rows(merge.merge(target, source, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(merge.merge(target, source.filter("false"), ["k"])) == [(1, "a"), (2, "b")]


def test_merge_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="duplicate merge key"):
        merge.merge(target, source, ["k"]).collect()


def test_merge_keeps_null_keys(spark):
    target = spark.createDataFrame([(None, "t")], "k int, v string")
    source = spark.createDataFrame([(None, "s"), (None, "s2")], "k int, v string")
    assert merge.merge(target, source, ["k"]).count() == 3


def test_as_of(spark):
    changes = spark.sql("""SELECT * FROM VALUES
        (1, 0, 'a', TIMESTAMP '2024-01-01'), (1, 1, 'b', TIMESTAMP '2024-01-05'),
        (2, 1, 'c', TIMESTAMP '2024-01-06') AS t(k, version, v, at)""")
    assert [r[2] for r in rows(history.as_of_version(changes, ["k"], 0))] == ["a"]
    assert [r[2] for r in rows(history.as_of_version(changes, ["k"], 1))] == ["b", "c"]
    assert [r[2] for r in rows(history.as_of_timestamp(changes, ["k"], "2024-01-05", "at"))] == ["b"]


def test_incremental_load(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.sql("SELECT id, TIMESTAMP '2024-01-01' + make_dt_interval(0, id) AS t FROM range(48)").write.parquet(path)
    source = spark.read.parquet(path)
    now = F.lit("2024-01-03").cast("timestamp")
    target = source.filter("id <= 10")
    newer = incremental.incremental_load(source, target, "t", now)
    assert [r[0] for r in rows(newer)] == list(range(11, 48))
    assert "GreaterThanOrEqual(t,ScalarSubquery" in plan(newer)
    again = incremental.incremental_load(source, target, "t", now, overlap_hours=2)
    assert [r[0] for r in rows(again)] == list(range(8, 48))
    first = incremental.incremental_load(source, None, "t", now, lookback_hours=5)
    assert [r[0] for r in rows(first)] == list(range(43, 48))
    empty = incremental.incremental_load(source, target.filter("false"), "t", now, lookback_hours=5)
    assert rows(empty) == rows(first)


def test_retention_keeps_the_border_day(spark):
    df = spark.sql("SELECT DATE '2024-01-11' AS d UNION ALL SELECT DATE '2024-01-10'")
    assert rows(retention.retain(df, "d", "2024-01-21", 10)) == [(dt.date(2024, 1, 11),)]
    assert retention.retain_layer(df, "gold", "d", "2024-01-21").count() == 2


def test_lookups(spark):
    left = spark.createDataFrame([("1", "a@x"), ("2", None), ("3", "b@x"), ("4", None)], "id string, email string")
    right = spark.createDataFrame([("a@x", 10), (None, 99)], "mail string, n int")
    want = [("1", "a@x", 10), ("2", None, None), ("3", "b@x", None), ("4", None, None)]
    assert sorted(rows(enrich.lookup(left, "email", right, "mail")), key=str) == sorted(want, key=str)
    spread = enrich.lookup_spread(left, "email", "id", right, "mail")
    assert sorted((tuple(r) for r in spread.collect()), key=str) == sorted(want, key=str)
    assert rows(enrich.restrict_to(left, "email", right, "mail")) == [("1", "a@x")]


def test_running_totals(spark):
    df = spark.createDataFrame([("2024-01-02", 2), ("2024-01-01", 1), ("2024-01-03", None)], "d string, n int")
    got = running.running_totals(df, "d", {"total": "n"}).orderBy("d").collect()
    assert [r.total for r in got] == [1, 3, 3]


def test_quality_report(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a', 'text', DATE '2024-01-01'), ('a', 'odd', DATE '2024-03-01'),
        (NULL, NULL, NULL) AS t(k, kind, d)""")
    report = quality.quality_report(df, "t", ["k"], ["kind"], {"kind": ["text"]}, ["d"], "2024-01-31")
    got = {r["check"]: (r.failed, r.total) for r in report.collect()}
    assert got == {
        "null:k": (1, 3), "null:kind": (1, 3), "duplicate:k": (1, 3), "enum:kind": (1, 3), "future:d": (1, 3),
    }
    with pytest.raises(ValueError):
        quality.quality_report(df, "t", ["k"], not_future=["d"])


def test_write_counts_rows_and_upsert_needs_a_fresh_folder(spark, tmp_path):
    path, merged = str(tmp_path / "t"), str(tmp_path / "t2")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, p int")
    change = spark.createDataFrame([(2, "B", 2), (3, "C", 3)], "k int, v string, p int")
    assert tables.upsert_table(spark, first, path, ["k"], ["p"]) == 2
    with pytest.raises(ValueError):
        tables.upsert_table(spark, change, path, ["k"], ["p"])
    assert tables.upsert_table(spark, change, path, ["k"], ["p"], out_path=merged) == 3
    assert rows(tables.read_table(spark, merged).select("k", "v")) == [(1, "a"), (2, "B"), (3, "C")]
    assert tables.find_table(spark, str(tmp_path / "none")) is None


def test_upsert_partitions_rewrites_only_touched_directories(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, "n", None), (5, "m", None)], "k int, v string, p int")
    change = spark.createDataFrame([(2, "B", 2), (3, "C", 3), (4, "N", None)], "k int, v string, p int")
    tables.upsert_partitions(spark, first, path, ["k"], ["p"], str(tmp_path / "s0"))
    untouched = sorted((tmp_path / "t" / "p=1").glob("*.parquet"))
    tables.upsert_partitions(spark, change, path, ["k"], ["p"], str(tmp_path / "s1"))
    assert rows(tables.read_table(spark, path).select("k", "v")) == [
        (1, "a"), (2, "B"), (3, "C"), (4, "N"), (5, "m"),
    ]
    assert sorted((tmp_path / "t" / "p=1").glob("*.parquet")) == untouched
    moved = spark.createDataFrame([(2, "B", 1)], "k int, v string, p int")
    with pytest.raises(ValueError, match="changed its partition"):
        tables.upsert_partitions(spark, moved, path, ["k"], ["p"], str(tmp_path / "s2"), check_moved=True)


def test_upsert_partitions_has_one_form_for_any_number_of_directories(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1600).selectExpr("id AS k", "'old' AS v", "CAST(id AS INT) AS p").coalesce(1).write.partitionBy("p").parquet(path)
    change = spark.range(50, 1550).selectExpr("id AS k", "'new' AS v", "CAST(id AS INT) AS p").coalesce(1)
    assert tables.upsert_partitions(spark, change, path, ["k"], ["p"]) == 1500
    got = spark.read.parquet(path).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {"old": 100, "new": 1500}


def test_upsert_scans_the_range_of_the_batch_only(spark, tmp_path):
    path, batch = str(tmp_path / "t"), str(tmp_path / "b")
    spark.range(30).selectExpr("id AS k", "CAST(id % 3 AS INT) AS p").write.partitionBy("p").parquet(path)
    spark.range(1).selectExpr("1L AS k", "1 AS p").write.parquet(batch)
    near = tables.in_same_directories(spark.read.parquet(path), spark.read.parquet(batch), ["p"])
    assert near.count() == 10
    scan = next(line for line in plan(near).splitlines() if "FileScan" in line and "/t]" in line)
    assert "Subquery" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_a_source_is_computed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 1)], "k int, v string, p int")
    tables.upsert_partitions(spark, first, path, ["k"], ["p"])
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame([(1, "b", 1), (2, "c", 1)], first.schema).mapInArrow(count, first.schema)
    tables.upsert_partitions(spark, source, path, ["k"], ["p"])
    assert seen.value == 2
    assert rows(spark.read.parquet(path).select("k", "v")) == [(1, "b"), (2, "c")]


def test_layout_keeps_all_rows_and_splits_a_hot_value(spark, tmp_path):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS c", "id")
    ordered = layout.cluster(df, ["c"], spread=["id"], partitions=6)
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 900
    src, out = str(tmp_path / "a"), str(tmp_path / "b")
    df.repartition(20).write.parquet(src)
    tables.compact_table(spark, src, out)
    assert len(list((tmp_path / "b").glob("*.parquet"))) < 20
    assert tables.read_table(spark, out).count() == 3000


def test_reader_options():
    options = readers.relational_options("jdbc:x", "users", "drv", "u", "p", "id", (0, 100), 8)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["user"] == "u"
    with pytest.raises(ValueError):
        readers.relational_options("jdbc:x", "users", "drv", split_on="id")


def test_inputs_use_every_supplier_and_turn(spark):
    from palaver.sources import fixtures

    sf_dir = "/root/testdata/sf0.01"
    pairs = fixtures.raw_calls(spark, sf_dir).selectExpr("_id.oid", "explode(participantIds)").distinct().count()
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    assert pairs == lines.count()
    texts = fixtures.table(spark, sf_dir, "conversations").select("text").distinct()
    told = fixtures.raw_messages(spark, sf_dir, versions=False).select(F.col("content").alias("text")).distinct()
    assert texts.join(told, "text", "left_anti").count() == 0


def test_expired_days_are_removed_and_nothing_else(spark, tmp_path):
    path = str(tmp_path / "t")
    days = ["2023-12-31", "2024-01-01", "2024-01-10", "2024-01-11", "2024-03-01"]
    rows = spark.createDataFrame([(d,) for d in days] + [(None,)], "d string").selectExpr(
        "d", "year(d) AS year", "month(d) AS month", "day(d) AS day"
    )
    tables.write_table(rows, path, ("year", "month", "day"))
    kept = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet") if "month=3" in str(f)}
    limits = retention.retain_partitions(rows, "2024-04-10", 90).count()
    gone = retention.expire_days(spark, path, "2024-04-10", 90)
    assert gone == [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 10)]
    assert sorted(str(r.d) for r in spark.read.parquet(path).collect()) == ["2024-01-11", "2024-03-01", "None"]
    assert limits == 2 and all(f.stat().st_mtime_ns == t for f, t in kept.items())
    assert retention.expire_days(spark, path, "2024-04-10", 90) == []
    assert retention.expire_days(spark, str(tmp_path / "none"), "2024-04-10", 90) == []


def test_interleaved_files_are_skipped_by_either_column(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "id", "'c' || lpad(CAST(xxhash64(id) % 997 AS STRING), 6, '0') AS c",
        "IF(id % 3 = 0, 'hot', 's' || lpad(CAST(abs(xxhash64(id, 1)) % 499 AS STRING), 6, '0')) AS s", "id % 7 AS _place",
    ).withColumn("s", F.when(F.col("id") % 1000 > 0, F.col("s")))
    loose = str(tmp_path / "loose")
    rows.write.parquet(loose)
    table = spark.read.parquet(loose)

    def opened(df, name):
        df.write.parquet(str(tmp_path / name))
        back = spark.read.parquet(str(tmp_path / name))
        assert back.columns == table.columns and back.exceptAll(table).isEmpty() and back.count() == 40_000
        files = back.groupBy(F.input_file_name()).agg(*[f(k).alias(f"{f.__name__}_{k}") for k in "cs" for f in (F.min, F.max)]).collect()
        biggest = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert biggest < 2 * 40_000 / 16
        shares = []
        for k in "cs":
            values = [r[0] for r in back.select(k).dropna().distinct().collect()]
            hits = sum(f[f"min_{k}"] <= v <= f[f"max_{k}"] for v in values for f in files)
            shares.append(hits / len(values) / len(files))
        return shares

    both = opened(layout.cluster_interleaved(table, ["c", "s"], ["id"], partitions=16), "both")
    plain = opened(layout.cluster(table, ["c", "s"], ["id"], partitions=16), "plain")
    assert max(both) <= 0.5 and plain[0] <= 0.2 and plain[1] >= 0.9


def test_interleaving_of_few_null_or_no_values(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, None, 5.0), (2, None, None)], "a int, b string, c double")
    for rows in (df, df.filter("false")):
        out = layout.cluster_interleaved(rows, ["a", "b", "c"], partitions=2)
        assert sorted(map(str, out.collect())) == sorted(map(str, rows.collect()))
    few = spark.range(5).select("id", layout.range_rank("id", [0, 1, 2], 64).alias("rank")).collect()
    assert [r["rank"] for r in few] == [0, 16, 32, 48, 48]
    number = layout.interleaved([F.lit(5), F.lit(3)], 3)
    assert spark.range(1).select(number).first()[0] == 0b100111
    with pytest.raises(ValueError):
        layout.cluster_interleaved(df, ["a", "b", "c"], bits=21)


def test_upsert_partitions_stages_each_row_once(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    ddl = "k string, p int, v string"
    first = [("a", 1, "old"), ("b", 1, "old"), ("c", 2, "old"), (None, 1, "loose")]
    tables.replace_table(spark.createDataFrame(first, ddl), path, ["p"])
    change = spark.createDataFrame([("a", 1, "new"), ("d", 3, "new")], ddl)
    assert tables.upsert_partitions(spark, change, path, ["k"], ["p"], staging) == 4
    assert sorted(r.v for r in spark.read.parquet(staging).collect()) == ["loose", "old"]
    rows = {(r.k, r.p, r.v) for r in spark.read.schema(ddl).parquet(path).collect()}
    assert rows == {("a", 1, "new"), ("b", 1, "old"), ("c", 2, "old"), ("d", 3, "new"), (None, 1, "loose")}


def test_a_merge_leaves_nothing_but_the_table(spark, tmp_path):
    """Neither staged rows nor folders beside the table stay, and the session keeps its settings."""
    path, scratch = tmp_path / "t", Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    ddl = "k string, p int, v string"
    tables.replace_table(spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), ("c", 2, "old")], ddl), str(path), ["p"])
    before, setting = set(scratch.glob("*")), spark.conf.get(tables.CLEANUP)
    change = spark.createDataFrame([("a", 1, "new"), (None, 1, "new"), ("d", 3, "new")], ddl)
    assert tables.upsert_partitions(spark, change, str(path), ["k"], ["p"]) == 4
    assert set(scratch.glob("*")) == before and spark.conf.get(tables.CLEANUP) == setting
    assert [f.name for f in tmp_path.iterdir()] == ["t"]
    got = spark.read.schema(ddl).parquet(str(path)).collect()
    assert {(r.k, r.p, r.v) for r in got} == {
        ("a", 1, "new"), ("b", 1, "old"), ("c", 2, "old"), ("d", 3, "new"), (None, 1, "new"),
    }


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    local = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    gone = tables.staged(spark.range(1000).repartition(4, "id"), "rows")
    before = set(local.rglob("shuffle_*.data"))
    tables.write_table(gone.repartition(5, "id"), str(tmp_path / "t"))
    until = time.monotonic() + 30  # they are removed behind the job
    while set(local.rglob("shuffle_*.data")) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not set(local.rglob("shuffle_*.data")) - before
    folder = Path(gone.inputFiles()[0].removeprefix("file://")).parent
    tables.discard(gone)
    assert not folder.exists()


def test_a_move_that_failed_is_finished_by_another(spark, tmp_path, monkeypatch):
    path, aside = str(tmp_path / "t"), str(tmp_path / "aside")
    frame = spark.range(6).selectExpr("id AS k", "CAST(id % 3 AS INT) AS p")
    tables.replace_table(frame.withColumn("v", F.lit("old")), path, ["p"])
    tables.replace_table(frame.filter("p < 2").withColumn("v", F.lit("new")), aside, ["p"])
    plain, moves = Files.move, []

    def fails(self, *where):
        moves.append(where)
        if len(moves) == 4:
            raise OSError("stopped")
        plain(self, *where)

    monkeypatch.setattr(Files, "move", fails)
    with pytest.raises(OSError, match="stopped"):
        tables.place_directories(spark, aside, path, ["p"])
    monkeypatch.setattr(Files, "move", plain)
    tables.place_directories(spark, aside, path, ["p"])
    got = spark.read.parquet(path).collect()
    assert sorted((r.k, r.v) for r in got) == [(k, "old" if k % 3 == 2 else "new") for k in range(6)]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("replaced, joined", [
    (range(0, 100), False), (range(100, 200), False), (range(0, 10), True), (range(5, 100), True),
])
def test_rows_that_stay_are_found_by_the_smaller_set_of_keys(spark, tmp_path, replaced, joined):
    """All or none of the rows go without a join; else the join is with the fewer keys."""
    path, ddl = str(tmp_path / "t"), "k bigint, p int, v string"
    spark.range(100).selectExpr("id AS k", "1 AS p", "'old' AS v").unionByName(
        spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS k", "1 AS p", "'old' AS v")
    ).write.parquet(path)
    source = spark.createDataFrame([(k, 1, "new") for k in replaced], ddl)
    kept, folder = tables._staying(spark.read.schema(ddl).parquet(path), source, ["k"])
    assert sorted(r.k for r in kept.dropna().collect()) == sorted(set(range(100)) - set(replaced))
    assert kept.filter("k IS NULL").count() == 1
    text = plan(kept)
    assert ("Join" in text) is joined
    assert ("LeftSemi" in text) is (len(set(range(100)) - set(replaced)) == 5)


def test_merging_keys_must_be_unique(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "k bigint, p int, v string"
    tables.replace_table(spark.createDataFrame([(1, 1, "old")], ddl), path, ["p"])
    with pytest.raises(Exception, match="duplicate merge key"):
        tables.upsert_partitions(spark, spark.createDataFrame([(1, 1, "x"), (1, 1, "y")], ddl), path, ["k"], ["p"])
    assert rows(tables.read_table(spark, path).select("k", "v")) == [(1, "old")]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]
