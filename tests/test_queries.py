"""Every registered query against its SQL, on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no input tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert difference(df, duck, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_entry_without_the_optional_subpackage(tmp_path):
    """A copy of the tree without its folder and its tests: the entry still offers all other queries."""
    root, copy = Path(__file__).parents[1], tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), 'pipeline' in e.queries())"
    for gone in ([], ["corpus_pipeline.py"]):
        for name in gone:
            (copy / name).unlink()
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
        assert out.stdout.split() == ["True", "False"], out.stderr
