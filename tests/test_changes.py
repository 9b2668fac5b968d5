"""Change folders: cost of a batch, retries, folds that stop, batch and stream at once."""

import os
from collections import Counter
from pathlib import Path

import pytest

from palaver.sources import changes, tables
from palaver.sources.changes import Keyed, append_changes, committed_batches, fold_changes, read_current

CONTRACT = {"id": "string", "day": "int", "v": "bigint", "what": "string"}
SPEC = Keyed(CONTRACT, ["id"], ["day"], "v", ["what"])
DDL = "id string, day int, v long, what string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), DDL)


def content(df):
    return Counter((r.id, r.day, r.v, r.what) for r in df.collect())


@pytest.fixture
def path(spark, tmp_path):
    out = str(tmp_path / "table")
    tables.replace_table(rows(spark, ("a", 1, 1, "old"), ("b", 1, 5, "old"), ("c", 2, 1, "old"), (None, 2, 1, "loose")), out, ["day"])
    return out


BASE = Counter({("a", 1, 1, "old"): 1, ("b", 1, 5, "old"): 1, ("c", 2, 1, "old"): 1, (None, 2, 1, "loose"): 1})
FIRST = [("a", 1, 2, "new"), ("b", 1, 4, "late version"), ("d", 3, 1, "new"), (None, 2, 1, "loose"), (None, 2, 1, "loose")]
SECOND = [("a", 1, 2, "tie"), ("a", 1, 1, "older"), ("d", 3, 1, "new")]
AFTER = Counter({("a", 1, 2, "tie"): 1, ("b", 1, 5, "old"): 1, ("c", 2, 1, "old"): 1, ("d", 3, 1, "new"): 1, (None, 2, 1, "loose"): 3})


def test_readers_take_the_latest_version(spark, path):
    assert content(read_current(spark, path, SPEC)) == BASE
    append_changes(rows(spark, *FIRST), path, 0)
    append_changes(rows(spark, *SECOND), path, 1)
    assert content(read_current(spark, path, SPEC)) == AFTER
    assert content(spark.read.schema(DDL).parquet(path)) == BASE
    assert fold_changes(spark, path, SPEC) == 2
    assert content(read_current(spark, path, SPEC)) == content(spark.read.schema(DDL).parquet(path)) == AFTER
    assert committed_batches(spark, path) == [] and fold_changes(spark, path, SPEC) == 0


def test_table_that_only_a_stream_wrote(spark, tmp_path):
    path = str(tmp_path / "fresh")
    append_changes(rows(spark, *FIRST), path, 0)
    expected = content(rows(spark, *FIRST))
    assert content(read_current(spark, path, SPEC)) == expected
    fold_changes(spark, path, SPEC)
    assert content(read_current(spark, path, SPEC)) == expected


def test_a_repeated_batch_changes_nothing(spark, path):
    for _ in range(2):
        append_changes(rows(spark, *FIRST), path, 7)
    append_changes(rows(spark, *SECOND), path, 8)
    assert content(read_current(spark, path, SPEC)) == AFTER
    fold_changes(spark, path, SPEC)
    append_changes(rows(spark, *SECOND, (None, 9, 9, "again")), path, 8)  # repeated after it was folded
    assert content(read_current(spark, path, SPEC)) == AFTER
    append_changes(rows(spark, ("e", 4, 1, "next")), path, 9)
    fold_changes(spark, path, SPEC)
    assert content(read_current(spark, path, SPEC)) == AFTER + Counter({("e", 4, 1, "next"): 1})


def test_batch_number_decides_without_a_version(spark, path):
    spec = Keyed(CONTRACT, ["id"], ["day"])
    for number, v in ((0, 9), (1, 3)):
        append_changes(rows(spark, ("a", 1, v, "x")), path, number)
    assert content(read_current(spark, path, spec))[("a", 1, 3, "x")] == 1


def files(root):
    return {str(p): (p.stat().st_size, p.stat().st_mtime_ns) for p in Path(root).rglob("*") if p.is_file()}


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    sizes = {}
    for base in (1_000, 200_000):
        path = str(tmp_path / f"t{base}")
        table = spark.range(base).selectExpr("CAST(id AS STRING) id", "1 day", "1L v", "'x' || id AS what")
        tables.replace_table(table, path, ["day"])
        before = files(path)
        append_changes(rows(spark, *FIRST).coalesce(1), path, 0)
        assert files(path) == before
        sizes[base] = sum(s for s, _ in files(changes.changes_path(path)).values())
    assert sizes[1_000] == sizes[200_000] < 5_000


@pytest.mark.parametrize("step", ["overwrite_partitions", "_finish"])
def test_a_fold_that_stopped_is_finished(spark, path, monkeypatch, step):
    append_changes(rows(spark, *FIRST), path, 0)
    append_changes(rows(spark, *SECOND), path, 1)
    plain, calls = getattr(changes, step), []

    def fails(*args):
        calls.append(1)
        if step == "overwrite_partitions":
            plain(*args)  # replaced, but nothing is cleared
        elif len(calls) == 1:
            return None
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(changes, step, fails)
        with pytest.raises(RuntimeError):
            fold_changes(spark, path, SPEC)
    assert fold_changes(spark, path, SPEC) == 0
    assert content(read_current(spark, path, SPEC)) == AFTER


def test_stream_and_batch_at_once(spark, path, monkeypatch):
    """A micro-batch that arrives while a fold replaces directories stays, and is folded by the next one."""
    append_changes(rows(spark, *FIRST), path, 0)
    plain = changes.overwrite_partitions

    def meanwhile(*args):
        append_changes(rows(spark, *SECOND, ("z", 1, 1, "meanwhile")), path, 1)
        return plain(*args)

    with monkeypatch.context() as patch:
        patch.setattr(changes, "overwrite_partitions", meanwhile)
        assert fold_changes(spark, path, SPEC) == 1
    expected = AFTER + Counter({("z", 1, 1, "meanwhile"): 1})
    assert content(read_current(spark, path, SPEC)) == expected
    assert fold_changes(spark, path, SPEC) == 1
    assert content(spark.read.schema(DDL).parquet(path)) == expected


def test_an_unfinished_batch_is_not_seen(spark, path):
    append_changes(rows(spark, *FIRST), path, 0)
    (done,) = Path(changes.changes_path(path)).rglob("_SUCCESS")
    os.remove(done)
    assert content(read_current(spark, path, SPEC)) == BASE


def test_a_fold_stages_each_row_once(spark, path, monkeypatch):
    sizes, plain = [], changes.write_table
    monkeypatch.setattr(changes, "write_table", lambda df, out, *a, **k: sizes.append((out, plain(df, out, *a, **k))))
    append_changes(rows(spark, *FIRST), path, 0)
    assert fold_changes(spark, path, SPEC) == 1
    # a, b and d are current and two loose rows new; c and the loose row of the table stay.
    assert sorted(n for out, n in sizes if "/fold-" in out) == [2, 5]
    assert content(spark.read.schema(DDL).parquet(path)) == AFTER - Counter({("a", 1, 2, "tie"): 1}) + Counter({("a", 1, 2, "new"): 1})
