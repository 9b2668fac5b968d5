"""Data-quality report: counters in one pass per table, repeated keys in another over the key alone; one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.functions.calendar import AsOf, as_date


def quality_report(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    required: Sequence[str] = (),
    enums: Mapping[str, Sequence[str]] | None = None,
    not_future: Sequence[str] = (),
    as_of: AsOf | None = None,
) -> DataFrame:
    """Columns (table, check, failed, total).

    Checks: ``null:<column>`` for keys and required columns, ``duplicate:<keys>`` (rows beyond the first of a fully
    set key), ``enum:<column>`` (set, but not a listed value), ``future:<column>`` (dated after ``as_of``).
    """
    if not_future and as_of is None:
        raise ValueError("not_future checks need as_of")
    one = F.lit(1)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()

    checks = {f"null:{c}": F.count(F.when(F.col(c).isNull(), one)) for c in dict.fromkeys([*keys, *required])}
    for c, allowed in (enums or {}).items():
        checks[f"enum:{c}"] = F.count(F.when(~F.col(c).isin(*allowed), one))
    for c in not_future:
        checks[f"future:{c}"] = F.count(F.when(F.to_date(c) > as_date(as_of), one))

    # The keys alone go through this shuffle; the counters above combine to one row for each task.
    copies = df.filter(complete).groupBy(*keys).agg(F.count(one).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate:" + ",".join(keys))
    )
    measured = df.agg(F.count(one).alias("total"), *[e.alias(name) for name, e in checks.items()])
    measured = measured.withColumn(copies.columns[0], copies.scalar())
    checks[copies.columns[0]] = F.lit(None)
    outcome = F.explode(
        F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failed")) for n in checks])
    ).alias("o")
    return measured.select("total", outcome).select(
        F.lit(table).alias("table"), F.col("o.check").alias("check"), F.col("o.failed").alias("failed"), "total"
    )
