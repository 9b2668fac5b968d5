import datetime as dt

from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions import arrays, calendar, columns
from palaver.schemas import conform


def test_null_arrays_count_as_empty_in_both_ansi_modes(spark):
    df = spark.createDataFrame([(None,), ([],), ([("a",), ("a",), ("b",)],)], "m array<struct<u:string>>")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = df.select(arrays.size_or_zero(F.col("m")), arrays.distinct_members(F.col("m"), "u")).collect()
            assert [tuple(r) for r in got] == [(0, 0), (0, 0), (3, 2)]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_or_empty_keeps_the_type(spark):
    df = spark.createDataFrame([(None,)], f"a {schemas.ATTACHMENTS}")
    out = df.select(arrays.or_empty(F.col("a"), schemas.ATTACHMENTS).alias("a"))
    assert out.schema["a"].dataType == df.schema["a"].dataType
    assert out.first().a == []


def test_flatten_struct_puts_fields_last(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', 'x') AS s, 5 AS k")
    assert columns.flatten_struct(df, "s").columns == ["k", "a", "b"]
    assert columns.flatten_struct(df, "s", "p").columns == ["k", "p_a", "p_b"]


def test_fill_defaults_skips_other_types(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, n long, o string")
    row = columns.fill_defaults(df, {"s": "x", "n": 7, "o": ["no"]}).first()
    assert (row.s, row.n, row.o) == ("x", 7, None)


def test_trim_and_require(spark):
    df = spark.createDataFrame([("  Ab ",), (None,)], "s string")
    assert columns.trim_strings(df, ["s"], lowercase=True).first().s == "ab"
    assert columns.require(df, ["s"]).count() == 1


def test_time_parts_sunday_is_one(spark):
    row = columns.with_time_parts(spark.sql("SELECT TIMESTAMP '2024-01-07 23:30:00' AS t"), "t").first()
    assert (row.year, row.month, row.day, row.hour, row.dayOfWeek, row.isWeekend) == (2024, 1, 7, 23, 1, True)


def test_since_prunes_directories_and_compares_at_midnight(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("""SELECT TIMESTAMP '2024-01-24 00:00:00' AS createdAt
        UNION ALL SELECT TIMESTAMP '2024-01-23 23:59:59' UNION ALL SELECT TIMESTAMP '2023-06-01 00:00:00'""")
    columns.with_time_parts(rows, "createdAt").write.partitionBy("year", "month", "day").parquet(path)
    recent = columns.since(spark.read.parquet(path), "createdAt", calendar.as_date("2024-01-24"))
    assert [r.createdAt for r in recent.collect()] == [dt.datetime(2024, 1, 24)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_busiest_hour_ties(spark):
    rows = spark.sql("""SELECT id, make_timestamp(2024, 1, 1, h, 0, 0) AS t FROM VALUES
        (1, 3), (1, 3), (1, 9), (1, 9), (1, 20) AS v(id, h)""")
    counted = rows.groupBy("id").agg(*calendar.hour_counts("t"))
    assert counted.select(calendar.busiest_hour(), calendar.busiest_hour(ties="last")).first()[:] == (3, 9)
    empty = rows.filter("false").agg(*calendar.hour_counts("t"))
    assert empty.select(calendar.busiest_hour()).first()[0] is None


def test_date_math(spark):
    row = spark.sql("SELECT DATE '2024-01-01' AS a, DATE '2024-01-31' AS b").select(
        calendar.days_between(F.col("a"), F.col("b")), calendar.days_since(F.col("a"), "2024-01-03"),
        calendar.hours_before(F.lit("2024-01-02").cast("timestamp"), 24),
    ).first()
    assert row[:] == (30, 2, dt.datetime(2024, 1, 1))


def test_conform_orders_and_casts(spark):
    df = spark.sql("SELECT 'x' AS extra, 2L AS b, '1' AS a")
    out = conform(df, {"a": "int", "b": "int"})
    assert out.schema.simpleString() == "struct<a:int,b:int>"
