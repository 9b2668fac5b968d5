"""Age limits per layer."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.functions.calendar import AsOf, as_date
from palaver.sources.files import Files

# Days each layer keeps.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": 730}


def retain(df: DataFrame, date_column: str, as_of: AsOf, days: int) -> DataFrame:
    """Rows dated within the last ``days`` days. A date made of partition columns prunes directories."""
    return df.filter(F.col(date_column).cast("date") >= F.date_sub(as_date(as_of), days))


def retain_partitions(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """The same on a table laid out by year/month/day: only partition columns are compared."""
    return df.filter(F.make_date("year", "month", "day") >= F.date_sub(as_date(as_of), days))


def retain_layer(df: DataFrame, layer: str, date_column: str, as_of: AsOf) -> DataFrame:
    return retain(df, date_column, as_of, RETENTION_DAYS[layer])


def day_directories(spark: SparkSession, path: str) -> dict[str, dt.date]:
    """Directories of a table laid out by year/month/day with their day, from their names alone: no file is opened."""
    out = {}
    for folder in Files(spark, path).matching(f"{path.rstrip('/')}/year=*/month=*/day=*"):
        parts = re.search(r"/year=(\d+)/month=(\d+)/day=(\d+)$", folder)
        if parts:  # rows without a day sit in a default directory, which never expires
            out[folder] = dt.date(*map(int, parts.groups()))
    return out


def expire_days(spark: SparkSession, path: str, as_of: AsOf, days: int) -> list[dt.date]:
    """Remove the directories of days that ``retain_partitions`` would leave out; the removed days are returned.

    Whole directories go through the file system, so nothing is read or rewritten. Repeating it removes nothing more.
    """
    first = spark.range(1).select(F.date_sub(as_date(as_of), days)).first()[0]
    old = {folder: day for folder, day in day_directories(spark, path).items() if day < first}
    files = Files(spark, path)
    for folder in old:
        files.remove(folder)
    return sorted(old.values())
