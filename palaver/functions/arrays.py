"""Array helpers. A null array counts as empty everywhere, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_array(dtype: str) -> Column:
    return F.array().cast(dtype)


def or_empty(column: Column, dtype: str) -> Column:
    """The array itself, or a typed empty array when it is null."""
    return F.coalesce(column, empty_array(dtype))


def size_or_zero(column: Column) -> Column:
    return F.when(column.isNull(), F.lit(0)).otherwise(F.size(column))


def member_field(column: Column, field: str) -> Column:
    """One field of every struct in the array."""
    return F.transform(column, lambda member: member.getField(field))


def distinct_members(column: Column, field: str) -> Column:
    """How many different values a struct field takes across the array."""
    return size_or_zero(F.array_distinct(member_field(column, field)))
