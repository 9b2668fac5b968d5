"""Looking up keys in a table that may be large: frequent keys in the task, the others by a join.

The frequent ones are all keys from a count on, chosen so that there are at most ``FREQUENT`` of them: a broadcast of a fixed
size. What is left to the join is spread, since each of its keys is rare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FREQUENT = 1 << 18


def frequent(counted: DataFrame, n: str, most: int = FREQUENT) -> DataFrame:
    """Rows of ``counted`` (one for each key, read twice) with the highest counts ``n``, at most ``most`` of them.

    Counts are put into classes of eight to a doubling, and whole classes are taken from the top.
    """
    size = F.floor(F.log2(F.col(n).cast("double")) * 8)
    taken, least = 0, None
    for row in counted.filter(F.col(n) > 0).groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():
        taken += row["count"]
        if taken > most:
            break
        least = row["size"]
    return counted.filter(F.lit(False)) if least is None else counted.filter((F.col(n) > 0) & (size >= least))
