"""Words of texts as numpy arrays, taken from the bytes of Arrow batches without a Python object per word.

A word is a run of ASCII letters, ASCII digits and non-ASCII characters of the lower-cased text. Everything else
separates words. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(x: np.ndarray, salt: int) -> np.ndarray:
    return mix(x + np.uint64(salt * int(_BASE) % (1 << 64)))


_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)]] = True
_BYTE = hashed(np.arange(256, dtype=np.uint64), 1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))]) for b in (_BASE, inverse)
        ]
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of several texts in a row: those of text ``i`` are ``first[i]:first[i + 1]``."""

    first: np.ndarray
    hashes: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without nulls."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def plain_array(column) -> pa.Array:
    """One string array without nulls."""
    texts = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(texts, "")


def words_of(texts: pa.Array) -> Words:
    offsets, data = string_buffers(pc.utf8_lower(plain_array(texts)))
    inside = _IS_WORD[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = np.flatnonzero(np.diff(offsets))
    before[offsets[filled]] = False
    after[offsets[filled + 1] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # pieces of the buffer, so that 8-byte temporaries stay small however long a text is
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES, side="right")))
        low, high = starts[at], ends[to - 1]
        power, inverse = _power_tables(max(CHUNK_BYTES, int(high - low)))
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * power[: high - low], out=total[1:])
        out[at:to] = (total[ends[at:to] - low] - total[starts[at:to] - low]) * inverse[starts[at:to] - low]
        at = to
    return Words(np.searchsorted(starts, offsets), mix(out), data, starts, ends)


def sliced(
    batches: Iterable[pa.RecordBatch], column: str, most: int = CHUNK_BYTES, rows: int = 4096
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds at most ``rows`` rows and ``most`` bytes of ``column``, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            to = min(at + rows, max(at + 1, int(np.searchsorted(total, done + most, side="right"))))
            yield batch.slice(at, to - at)
            at = to


def grams(words: Words, gap: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of word pairs ``gap`` apart inside one text, and the text of each."""
    text = words.text_of
    if len(text) <= gap:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = text[gap:] == text[:-gap]
    pair = hashed(words.hashes[:-gap][same] * np.uint64(3) + hashed(words.hashes[gap:][same], salt), salt)
    return pair, text[gap:][same]


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row, and the first of each text; a shorter text with words is one shingle."""
    counts = words.counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(words.first[:-1] - first[:-1], n) + np.arange(first[-1])  # word that opens each shingle
    length = np.repeat(np.minimum(counts, size), n)
    out = np.zeros(first[-1], np.uint64)
    last = max(len(words.hashes) - 1, 0)
    for k in range(size):
        step = out * np.uint64(5) + words.hashes[np.minimum(at + k, last)] if len(at) else out
        out = np.where(k < length, mix(step + np.uint64(k + 1)), out)
    return out, first
