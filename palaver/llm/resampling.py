"""Importance resampling towards a target collection: array-scored weights, ranks by parallel sorting by regular sampling.

Words are runs of ASCII digits, ASCII letters and non-ASCII characters after lower-casing A-Z; features are all runs of one
to three words, joined by one space, with repeats. A feature falls into the bucket of its CRC-32. Each task counts its
texts into one array of all buckets; the arrays are added up for source and target, a bucket's gain is the scaled log ratio
of its smoothed shares, and the array of gains (``BUCKETS`` numbers, however large the corpus) scores every text.

Drawing without replacement by weight is taking the highest of weight + Gumbel noise, whose noise is a hash of doc_id.
The exact order comes from parallel sorting by regular sampling:

1. every task sorts its rows into a run, which is written with its positions;
2. regular samples of all runs, ``SAMPLES`` at most, are sorted; regular picks of these are the splitters;
3. each row goes to the segment between two splitters, segments that no drawn row can be in stay where they are;
4. a segment is sorted by itself, and the counts of the segments before it turn its row numbers into ranks.

The position in the run is the last part of the order, so that equal rows, however many, spread over segments. Up to 512
runs a segment holds at most twice its share (with p samples from each of p runs); with more runs the samples of one run
are fewer and the bound is looser. Ranks are exact whatever the samples are.

Defined results: a null or empty text has no features and weight 0; its score is the noise alone. A null doc_id hashes as
the empty string and sorts as the largest number. Texts of fewer than ``LEAST_WORDS`` words are scored and never drawn.
Repeated rows are drawn one by one. Without documents, or without a target, every share is the smoothed one.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table, written
from palaver.llm.words import sliced

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SCALE = 1000
# Rows of a segment, about, and samples gathered in all.
SEGMENT_ROWS, SAMPLES = 1_000_000, 1 << 18
# Words that are held as objects at a time.
TOGETHER = 1 << 16
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LARGEST = (1 << 63) - 1
_IN_RUN = (1 << 33) - 1


def word_blocks(text: str | None) -> Iterator[tuple[list[bytes], int]]:
    """Words of a text in blocks; the number says how many words of the block before are repeated in front."""
    found = (m.group() for m in _WORD.finditer((text or "").encode().lower()))  # bytes: A-Z only
    tail: list[bytes] = []
    while block := list(islice(found, TOGETHER)):
        yield tail + block, len(tail)
        tail = (tail + block)[-(LONGEST - 1) :]


def buckets_of(words: list[bytes], seen: int = 0) -> np.ndarray:
    """Bucket of every feature that ends after the first ``seen`` words. The CRC of a run goes on from that of its start."""
    spaced = [b" " + w for w in words]
    running = list(map(crc32, words))
    parts = [np.array(running[seen:], np.int64)]
    for k in range(1, LONGEST):
        running = list(map(crc32, spaced[k:], running))
        parts.append(np.array(running[max(seen - k, 0) :], np.int64))
    return np.concatenate(parts) % BUCKETS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            for words, seen in word_blocks(text.as_py()):
                total += np.bincount(buckets_of(words, seen), minlength=BUCKETS)
    filled = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: one array, added up from the arrays of the tasks."""
    parts = on_workers(texts).select("text").mapInArrow(_count, "bucket long, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of smoothed shares, rounded down."""
    over, under = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    ratio = (target + 1.0) * over / ((source + 1.0) * under)
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio.tolist()], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, words, n_features and weight of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows = []
            for text in batch.column("text"):
                n_words = n_features = weight = 0
                for words, seen in word_blocks(text.as_py()):
                    buckets = buckets_of(words, seen)
                    n_words += len(words) - seen
                    n_features += len(buckets)
                    weight += int(gain[buckets].sum())
                rows.append((n_words, n_features, weight))
            out = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(np.ascontiguousarray(out[:, i])) for i in range(3)]],
                names=["doc_id", "words", "n_features", "weight"],
            )

    return on_workers(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, words long, n_features long, weight long"
    )


def noisy(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Add score: weight plus Gumbel noise from a hash of doc_id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


def segment_of(keys: Sequence[np.ndarray], splitters: list[tuple[int, ...]]) -> np.ndarray:
    """Number of splitters below each row; ``keys`` are the columns of the order."""
    heads = np.array([s[0] for s in splitters], np.int64)
    out, last = np.searchsorted(heads, keys[0], side="left"), np.searchsorted(heads, keys[0], side="right")
    for i in np.flatnonzero(out < last):
        out[i] = bisect_left(splitters, tuple(int(k[i]) for k in keys), int(out[i]), int(last[i]))
    return out


def ranked(
    rows: DataFrame, order: Sequence[str], first: int, segment_rows: int = SEGMENT_ROWS, samples: int = SAMPLES
) -> DataFrame:
    """Add rank, from 1 to ``first`` in the order of the (long, not null) columns; null for the rest."""
    runs = written(
        rows.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "runs"
    )
    keys = [*order, "_at"]
    sizes = [r.n for r in runs.groupBy(F.shiftright("_at", 33)).agg(F.count(F.lit(1)).alias("n")).collect()]
    total = sum(sizes)
    segments = max(len(sizes), -(-total // segment_rows), 1)
    step = max(1, total // max(1, min(samples, len(sizes) * segments)))
    sampled = runs.filter((F.col("_at").bitwiseAND(F.lit(_IN_RUN)) % step) == step - 1).select(*keys).toArrow()
    drawn = sorted(zip(*[sampled.column(k).to_pylist() for k in keys]))
    every = max(1, -(-len(drawn) // segments))
    splitters = drawn[every - 1 :: every]
    columns = runs.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = segment_of([batch.column(k).to_numpy() for k in keys], splitters)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int64))], names=[*columns, "_segment"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
    dealt = written(on_workers(runs).mapInArrow(assign, f"{schema}, _segment long"), "segments")
    counts = dict(dealt.groupBy("_segment").agg(F.count(F.lit(1))).collect())
    before, at = [], 0
    for segment in sorted(counts):
        before.append((segment, at))
        at += counts[segment]
    needed = [b for b in before if b[1] < first]
    # One pair of numbers for each segment.
    offsets = rows.sparkSession.createDataFrame(needed, "_segment long, _before long")
    inside = dealt.join(F.broadcast(offsets), "_segment")
    number = F.expr(f"row_number() OVER (PARTITION BY _segment ORDER BY {', '.join(f'`{k}`' for k in keys)})")
    exact = inside.withColumn("rank", F.col("_before") + number)
    exact = exact.withColumn("rank", F.when(F.col("rank") <= first, F.col("rank")).cast("long"))
    rest = dealt.join(F.broadcast(offsets), "_segment", "left_anti").withColumn("rank", F.lit(None).cast("long"))
    return exact.select(*rows.columns, "rank").unionByName(rest.select(*rows.columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, **sorting) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; ``percent`` of the rows with enough words are drawn."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = noisy(weighed(docs, gain), seed)
    # Keys of the order: what may be drawn first, high scores first, low ids first.
    scored = written(
        scored.withColumn("_short", (F.col("words") < LEAST_WORDS).cast("long")).withColumn("_low", -F.col("score"))
        .withColumn("_id", F.coalesce("doc_id", F.lit(_LARGEST))),
        "scored",
    )
    enough = scored.filter("_short = 0")
    first = percent * enough.count() // 100
    drawn = ranked(enough, ["_low", "_id", "n_features"], first, **sorting)
    out = drawn.unionByName(scored.filter("_short = 1").withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op11_resampling(spark, sf_dir: str) -> DataFrame:
    """Weight, noisy score and rank of every document, drawn towards the benchmark texts."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
