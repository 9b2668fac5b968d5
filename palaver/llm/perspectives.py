"""Multi-party perspective rotation of dialogues, with DataFrame functions only.

A dialogue is rendered once for each of its speakers: that speaker's turns are the assistant's, the other speakers' turns
are those of named users, and turns of ``system`` stay system turns in every rendering. The result has one row for each
turn of each rendering, with its text, its place in the whole rendering (characters before it) and its training mask: the
characters that the assistant has to produce, its content and the end mark. Put end to end by ``nth``, the rows are the
rendering; no dialogue is ever held in one row or one task.

Turns are ordered by ``turn``, then speaker, length of the text and text. Places are prefix sums in three steps: inside
blocks (one turn number, one speaker, one range of lengths), over the blocks of ``TURNS`` turn numbers, and over those, so
that one huge dialogue is spread over many tasks, whether its turns are numbered apart or share a few numbers.

Defined results: a null or empty speaker is ``unknown``; a null text is empty; a null turn comes first. Rows with a null
dialogue id belong to no dialogue and are left out. Repeated rows are turns of their own. A dialogue of system turns only
has no speakers and no rendering. Columns other than conv_id, turn, role and text are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import table

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
SYSTEM, ASSISTANT, USER, UNKNOWN = "system", "assistant", "user", "unknown"
# Turn numbers, and lengths of a text, that are summed up together.
TURNS, LENGTHS = 256, 32


def _speaker(role: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(role), F.lit("")), F.lit(UNKNOWN))


def header_name(speaker: Column, perspective: Column) -> Column:
    """What stands after the opening mark: system, assistant, or a named user."""
    return (
        F.when(speaker == SYSTEM, F.lit(SYSTEM)).when(speaker == perspective, F.lit(ASSISTANT))
        .otherwise(F.concat(F.lit(f"{USER} name="), speaker))
    )


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, nth, turn, speaker, as_role, segment, start, mask_start, mask_end.

    ``start`` counts the characters of the rendering before this row; the mask is in characters of the whole rendering,
    null for turns that are not the assistant's.
    """
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", _speaker(F.col("role")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / TURNS).alias("_span"),
        F.floor(F.length(F.coalesce("text", F.lit(""))) / LENGTHS).alias("_long"),
    )
    people = rows.filter(F.col("speaker") != SYSTEM).select(
        "conv_id", F.col("speaker").alias("perspective")
    ).distinct()
    seen = rows.join(people, "conv_id").withColumn("as_role", header_name(F.col("speaker"), F.col("perspective")))
    head = F.concat(F.lit(OPEN), F.col("as_role"), F.lit(MIDDLE))
    seen = seen.withColumn("segment", F.concat(head, F.col("text"), F.lit(CLOSE)))
    size = F.length("segment").cast("long")

    whole, span = ["conv_id", "perspective"], ["conv_id", "perspective", "_span"]
    block = [*span, "turn", "speaker", "_long"]
    inner = Window.partitionBy(*block).orderBy(F.length("text"), "text")
    seen = seen.withColumn("_in", F.coalesce(F.sum(size).over(_before(inner)), F.lit(0)))
    seen = seen.withColumn("_row", F.row_number().over(inner) - 1)
    blocks = seen.groupBy(*block).agg(F.sum(size).alias("_size"), F.count(F.lit(1)).alias("_rows"))
    spans = blocks.groupBy(*span).agg(F.sum("_size").alias("_size"), F.sum("_rows").alias("_rows"))
    blocks = _summed(blocks, span, ["turn", "speaker", "_long"], block)
    places = _same(blocks, _summed(spans, whole, ["_span"], span), span).select(
        *[f"a.{c}" for c in block], (F.col("a._size") + F.col("b._size")).alias("_size"),
        (F.col("a._rows") + F.col("b._rows")).alias("_rows"),
    )
    start = F.col("b._size") + F.col("a._in")
    mine = F.col("a.as_role") == ASSISTANT
    return _same(seen, places, block).select(
        "a.conv_id", "a.perspective", (F.col("b._rows") + F.col("a._row")).alias("nth"), "a.turn", "a.speaker",
        "a.as_role", "a.segment", start.alias("start"),
        F.when(mine, start + F.lit(len(OPEN) + len(ASSISTANT) + len(MIDDLE))).alias("mask_start"),
        F.when(mine, start + F.length("a.segment")).alias("mask_end"),
    )


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _summed(totals: DataFrame, group: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """Characters and rows that come before each row of ``totals`` in its group."""
    window = _before(Window.partitionBy(*group).orderBy(*order))
    return totals.select(
        *keep, *[F.coalesce(F.sum(c).over(window), F.lit(0)).alias(c) for c in ("_size", "_rows")]
    )


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    return a.alias("a").join(b.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns])


def op4_perspectives(spark, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each of its speakers."""
    return rotate(table(spark, sf_dir, "conversations"))


ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') AS speaker, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (
  SELECT t.*, p.perspective,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
         ELSE 'user name=' || speaker END AS as_role
  FROM t JOIN p USING (conv_id)
),
r AS (SELECT *, '<|im_start|>' || as_role || chr(10) || text || '<|im_end|>' || chr(10) AS segment FROM s),
w AS (
  SELECT *, row_number() OVER o - 1 AS nth,
    coalesce(sum(length(segment)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM r
  WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, length(text), text)
)
SELECT conv_id, perspective, nth, turn, speaker, as_role, segment, start,
  CASE WHEN as_role = 'assistant' THEN start + 22 END AS mask_start,
  CASE WHEN as_role = 'assistant' THEN start + length(segment) END AS mask_end
FROM w
"""
