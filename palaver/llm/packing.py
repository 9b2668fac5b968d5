"""Best-fit packing of token sequences under several capacities at once.

A document is its ids and an end id. One longer than a sequence is cut into pieces of full length, of which the first may
be shorter. Pieces of full length are sequences of their own; the others are dealt at random, by hash, to groups of about
``GROUP`` pieces, and each group is packed on its own: from the longest piece down, each goes into the open sequence in
which it leaves the smallest weighted residual norm over three capacities (tokens, documents, attention cost), among those
where it fits under every one. Groups have the same mix of lengths, so packing them apart costs at most about one open
sequence for each group; their size is bounded whatever the input.

Defined results: a null or empty text is the end id alone. Repeated rows are packed once for each. Rows with a null
doc_id are packed as well.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table, written
from palaver.llm.tokens import encoder
from palaver.llm.words import sliced

END = 0
GROUP = 8192


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence; the attention cost of a document is its squared length."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    # Weights of the residual norm.
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)


def pieces(
    docs: DataFrame, capacity: Capacity = Capacity(), path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """doc_id, row (tells rows with the same doc_id apart), piece, start, length, ids_crc32; with ``with_ids`` the ids too."""
    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
    size = capacity.tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = encoder(path), 0
        for batch in sliced(batches, "text"):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode.ids(text or ""), np.uint32(END)).astype("<u4")
                head = len(ids) % size or size
                edges = [0, *range(head, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    part = ids[a:b]
                    out.append((doc_id, row, k, a, b - a, zlib.crc32(part.tobytes()), *([part] if with_ids else [])))
                row += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "row", "piece", "start", "length", "ids_crc32", "ids"]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return on_workers(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, schema + (", ids array<long>" if with_ids else "")
    )


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, taken in the order given."""
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    scale = np.array(capacity.weights)
    n = len(lengths)
    left = np.empty((3, n))  # residuals of open sequences, one column each, in units of the capacity
    used, name = np.zeros(n, np.int64), np.zeros(n, np.int64)  # tokens in an open sequence; its number
    sequence, offset, opened, made = np.zeros(n, np.int64), np.zeros(n, np.int64), 0, 0
    needs = np.stack([lengths, np.ones(n), lengths.astype(np.float64) ** 2]) / limits[:, None]
    for i in range(n):
        after = left[:, :opened] - needs[:, i : i + 1]
        fits = np.flatnonzero((after >= -1e-12).all(0))
        if len(fits):
            at = fits[np.argmin(scale @ (after[:, fits] ** 2))]
        else:
            at = opened
            left[:, at], used[at], name[at] = 1.0, 0, made
            opened, made = opened + 1, made + 1
        sequence[i], offset[i] = name[at], used[at]
        left[:, at] -= needs[:, i]
        used[at] += lengths[i]
        if used[at] == capacity.tokens or left[1:, at].min() < 1e-12:  # full: the last open one takes its column
            opened -= 1
            left[:, at], used[at], name[at] = left[:, opened], used[opened], name[opened]
    return sequence, offset


def pack(cut: DataFrame, capacity: Capacity = Capacity(), group: int = GROUP) -> DataFrame:
    """Pieces (a written table) with sequence_id and offset."""
    full = cut.filter(F.col("length") == capacity.tokens)
    short = cut.filter(F.col("length") < capacity.tokens)
    groups = max(1, -(-short.count() // group))
    place = F.xxhash64("doc_id", "row", "piece", F.lit(17))
    columns = [*cut.columns, "sequence_id", "offset"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "row", "piece"], ascending=[False, True, True, True])
        sequence, offset = best_fit(part["length"].to_numpy(), capacity)
        part["sequence_id"] = part["_group"].to_numpy() + groups * sequence
        part["offset"] = offset
        return part[columns]

    filled = (
        on_workers(short).withColumn("_group", F.pmod(place, F.lit(groups))).groupBy("_group")
        .applyInPandas(fill, f"{fields}, sequence_id long, offset long")
    )
    # Numbers of sequences of one full piece are negative: no other sequence has them.
    own = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return filled.unionByName(own.select(*columns))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """Packing of all documents into sequences of 2048 tokens."""
    return packing_stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = written(pieces(docs), "pieces")
    return pack(cut).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
