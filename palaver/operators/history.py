"""Read a change table as it stood at a version or a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.operators.dedup import deduplicate


def as_of_version(changes: DataFrame, keys: Sequence[str], version: int, column: str = "version") -> DataFrame:
    """Newest row per key among those written up to ``version``."""
    return deduplicate(changes.filter(F.col(column) <= version), keys, column)


def as_of_timestamp(
    changes: DataFrame, keys: Sequence[str], moment: str | Column, column: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key among those written up to ``moment``."""
    at = F.lit(moment).cast("timestamp") if isinstance(moment, str) else moment
    return deduplicate(changes.filter(F.col(column) <= at), keys, column, tie_break=tie_break)
