"""Frame helpers that add, clean or reshape columns without moving rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ETL_VERSION = "1.0.0"


def time_parts(ts: str | Column) -> dict[str, Column]:
    """Calendar parts of a timestamp; dayOfWeek runs 1 = Sunday .. 7 = Saturday."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return {
        "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c),
        "dayOfWeek": F.dayofweek(c), "isWeekend": F.dayofweek(c).isin(1, 7),
    }


def with_time_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(time_parts(ts))


def with_ingestion(df: DataFrame, source_system: str) -> DataFrame:
    return df.withColumns({"ingestTimestamp": F.current_timestamp(), "sourceSystem": F.lit(source_system)})


def with_processing(df: DataFrame) -> DataFrame:
    return df.withColumns({"processedAt": F.current_timestamp(), "etlVersion": F.lit(ETL_VERSION)})


def trim_strings(df: DataFrame, names: Iterable[str], lowercase: bool = False) -> DataFrame:
    tidy = (lambda c: F.lower(F.trim(c))) if lowercase else F.trim
    return df.withColumns({n: tidy(F.col(n)) for n in names})


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls by a default per column; values that are no string, number or boolean are ignored."""
    usable = {n: v for n, v in defaults.items() if isinstance(v, (str, int, float, bool))}
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in usable.items()}) if usable else df


def fill_columns(df: DataFrame, value: Any, names: Iterable[str]) -> DataFrame:
    return df.fillna(value, subset=list(names))


def flatten_struct(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Replace a struct column by its fields, placed last and optionally named ``prefix_field``."""
    fields = df.schema[column].dataType.fieldNames()
    lead = f"{prefix}_" if prefix else ""
    kept = [F.col(f"`{n}`") for n in df.columns if n != column]
    return df.select(*kept, *[F.col(f"`{column}`").getField(f).alias(lead + f) for f in fields])


def require(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep rows in which every named column is set."""
    return df.dropna(subset=list(names))


def since(df: DataFrame, ts: str, start: Column) -> DataFrame:
    """Rows with ``ts >= start`` (a date compares at midnight).

    Tables are laid out by year/month or year/month/day of the same time; naming those columns lets the scan skip
    directories. The extra predicates are a day wider than the real one, so a table written under another session zone
    loses no row.
    """
    rows, margin = df.filter(F.col(ts) >= start), F.date_sub(start, 1)
    if {"year", "month"} <= set(df.columns):
        rows = rows.filter(F.last_day(F.make_date("year", "month", F.lit(1))) >= margin)
    if {"year", "month", "day"} <= set(df.columns):
        rows = rows.filter(F.make_date("year", "month", "day") >= margin)
    return rows
