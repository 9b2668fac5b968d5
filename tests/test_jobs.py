"""Jobs run one by one."""

import pytest

from palaver.plans import lake
from palaver.plans.jobs import JOBS, run_jobs
from palaver.sources.files import Files
from tests.test_plans import AS_OF, lake_input


def contents(run, name):
    clocks = [c for c in ("processedAt", "ingestTimestamp") if c in run.table(name).columns]
    return sorted(str(r) for r in run.table(name).drop(*clocks).collect())


def test_jobs_one_by_one_equal_the_whole_run(spark, tmp_path):
    raw, one, other = lake_input(spark), str(tmp_path / "one"), str(tmp_path / "other")
    whole = lake.run_lake(spark, raw, one, AS_OF)
    assert set(JOBS) == set(whole.rows)
    for name in JOBS:
        done = run_jobs(spark, other, [name], AS_OF, raw)
        assert list(done.rows) == [name]
        assert contents(done, name) == contents(whole, name), name
    # A single job runs again on its own; a run of the activity alone leaves a note for the next daily run.
    weekly = run_jobs(spark, other, ["gold/metrics/weekly"], AS_OF)
    assert contents(weekly, "gold/metrics/weekly") == contents(whole, "gold/metrics/weekly")
    files, mark = Files(spark, other), lake._totals_mark(other)
    assert not files.exists(mark)
    run_jobs(spark, other, ["silver/user_activity"], AS_OF)
    assert files.exists(mark)
    run_jobs(spark, other, ["gold/analytics/user_totals"], AS_OF)
    assert not files.exists(mark)


def test_unknown_jobs_and_missing_inputs_write_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="gold/nothing"):
        run_jobs(spark, root, ["gold/nothing", "silver/users"], AS_OF)
    with pytest.raises(ValueError, match="auth"):
        run_jobs(spark, root, ["bronze/users"], AS_OF, {"users": lake_input(spark)["users"]})
    assert not (tmp_path / "lake").exists()
