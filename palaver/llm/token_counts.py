"""Token counts of sections, attributed by offsets.

A document is encoded once, whole. The character span of each token is then joined with the spans of the document's
sections (interval join on sorted ends), so that a section's count is what the document really costs, including merges
over section borders. Sections are the document's lines with their line break; runs of empty lines belong to the line
before, so sections are consecutive and cover the text.

Rule for a token that crosses a border: it goes to the section that holds most of its bytes; of equal shares, to the
earlier one. Every token goes to exactly one section, and the counts of a document add up to its tokens.

Defined results: a null or empty text has one section of no characters and no tokens. A text that opens with line breaks
has them in its first section. Repeated rows are counted each. A null doc_id is kept as a null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table
from palaver.llm.tokens import encoder
from palaver.llm.words import sliced


def section_ends(raw: np.ndarray) -> np.ndarray:
    """Byte ends of the sections of a text: after each line break that a character other than a line break follows."""
    breaks = raw == 10
    filled = np.flatnonzero(~breaks)
    if not len(filled):
        return np.array([len(raw)])
    end = np.flatnonzero(breaks[:-1] & ~breaks[1:]) + 1
    return np.append(end[end > filled[0]], len(raw))


def attribute(ends: np.ndarray, token_ends: np.ndarray) -> np.ndarray:
    """Section of each token. Both arrays are ascending ends of consecutive spans over the same bytes."""
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(ends, starts, side="right")  # section of the token's first byte
    last = np.searchsorted(ends, token_ends, side="left")  # and of its last
    out = first.copy()
    for t in np.flatnonzero(last > first):
        edges = np.clip(ends[first[t] - 1 if first[t] else 0 : last[t] + 1], starts[t], token_ends[t])
        edges = edges if first[t] else np.append(starts[t], edges)
        out[t] = first[t] + int(np.argmax(np.diff(edges)))
    return out


def section_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, section, start, end (characters) and tokens of every section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in sliced(batches, "text"):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                ends = section_ends(raw)
                token_ends = np.cumsum(encode.lengths[encode.ids(text or "")])
                tokens = np.bincount(attribute(ends, token_ends), minlength=len(ends)) if len(raw) else np.zeros(1, int)
                # Bytes that open a character, up to each section's end.
                chars = np.cumsum((raw & 0xC0) != 0x80)[ends - 1] if len(raw) else np.zeros(1, int)
                rows = (
                    np.full(len(ends), i), np.arange(len(ends)), np.concatenate([[0], chars[:-1]]), chars,
                    tokens[: len(ends)],
                )
                for column, values in zip(out, rows):
                    column.append(values)
            at, section, start, end, tokens = (np.concatenate(c) for c in out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at)), pa.array(section.astype(np.int32)),
                    pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64)), pa.array(tokens.astype(np.int64)),
                ],
                names=["doc_id", "section", "start", "end", "tokens"],
            )

    return on_workers(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, section int, start long, end long, tokens long"
    )


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return section_counts(table(spark, sf_dir, "documents"))
