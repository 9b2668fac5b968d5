"""Borders of every classification and score."""

import pytest
from pyspark.sql import functions as F

from palaver.functions import scores


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_engagement_score_caps_each_part_but_not_days(spark):
    rows = [(100, 20, 10, 30), (1000, 900, 90, 31), (0, 0, 0, 0), (50, 5, 1, 15)]
    schema = "m long, r long, c long, d long"
    args = [F.col(c) for c in "mrcd"]
    assert values(spark, rows, schema, scores.engagement_score(*args)) == [100.0, 101.0, 0.0, 37.0]
    assert values(spark, rows, schema, scores.engagement_score(*args, cap=True)) == [100.0, 100.0, 0.0, 37.0]
    assert values(spark, [(0, 0, 0, 7)], schema, scores.engagement_score(*args, max_days=7)) == [30.0]


@pytest.mark.parametrize("recent, past, want", [
    (5, 0, "stable"), (0, 0, "stable"), (13, 10, "increasing"), (12, 10, "stable"), (8, 10, "stable"),
    (7, 10, "decreasing"),
])
def test_activity_trend(spark, recent, past, want):
    got = values(spark, [(recent, past)], "a long, b long", scores.activity_trend(F.col("a"), F.col("b")))
    assert got == [want]


@pytest.mark.parametrize("active7, active30, idle, want", [
    (7, 30, 15, "high"), (7, 30, 14, "medium"), (7, 30, 8, "medium"), (7, 30, 7, "low"), (2, 17, 1, "medium"),
    (2, 16, 1, "low"), (0, 0, 999, "high"),
])
def test_churn_risk(spark, active7, active30, idle, want):
    risk = scores.churn_risk(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, [(active7, active30, idle)], "a long, b long, c int", risk) == [want]


@pytest.mark.parametrize("days, sent, want", [
    (25, 100, "power_user"), (25, 99, "regular"), (24, 100, "regular"), (15, 30, "regular"), (15, 29, "casual"),
    (5, 0, "casual"), (4, 500, "at_risk"), (1, 0, "at_risk"), (0, 500, "churned"),
])
def test_user_segment(spark, days, sent, want):
    assert values(spark, [(days, sent)], "a long, b long", scores.user_segment(F.col("a"), F.col("b"))) == [want]


@pytest.mark.parametrize("week, idle, want", [
    (50, 31, "dead"), (50, 30, "dying"), (50, 15, "dying"), (2, 14, "quiet"), (3, 1, "active"), (9, 1, "active"),
    (10, 1, "thriving"),
])
def test_conversation_health(spark, week, idle, want):
    health = scores.conversation_health(F.col("a"), F.col("b"))
    assert values(spark, [(week, idle)], "a long, b int", health) == [want]


def test_duration_category(spark):
    rows = [(0,), (59,), (60,), (599,), (600,), (None,)]
    want = ["short", "short", "medium", "medium", "long", "long"]
    assert values(spark, rows, "s long", scores.duration_category(F.col("s"))) == want


def test_categorize_is_half_open_and_first_match_wins(spark):
    buckets = [(0.0, 10.0, "a"), (5.0, 20.0, "b")]
    rows = [(0.0,), (9.9,), (10.0,), (20.0,), (-1.0,), (None,)]
    want = ["a", "a", "b", "unknown", "unknown", "unknown"]
    assert values(spark, rows, "v double", scores.categorize(F.col("v"), buckets)) == want
    assert values(spark, rows[:1], "v double", scores.categorize(F.col("v"), [])) == ["unknown"]
