"""Benchmark decontamination: latent semantic retrieval, then longest common subsequence and answer checks.

Passages are 64 words in a row; their terms are the words that occur in the benchmark, weighted by a smoothed inverse
passage frequency of 1 at least. One pass over all passages gives ``G @ Q`` for the Gram matrix ``G`` of the normalised
TF-IDF rows and a random orthonormal ``Q``; its Nystrom form is the randomised singular value decomposition (terms by
``RANK``). Benchmark items and windows of the documents are folded in as sums of term vectors over singular values.

Candidates are the windows of about 1, 1.5 and 2 times an item's length, a sixth of it apart, whose cosine with the item
reaches the item's threshold. That is measured in the same latent space: ``TRIALS`` edited copies of the item (0.4 of the
words replaced by words of the corpus, or as many inserted as it has) are folded in, and the threshold is what a share of
``RECALL`` of them reaches. A second, exact source adds what edits hide from the cosine. At least 0.6 of the item's words
must be in the region, so of the rarest 0.4 and ``ANCHORS`` more at least ``ANCHORS`` are; hits of these in the texts,
sorted by item and place, give the regions that have so many. ``by_cosine`` tells whether the cosine led to a leak.

Leaks are decided on the words themselves: an item is leaked if, in a stretch of twice its words, 0.8 of its words are a
common subsequence, or 0.6 of them with half of the words of its last sentence (its answer). Regions of that length and a
step more begin every step (a sixth of the item), so any such stretch lies inside one. Candidate regions that hold 0.6 of
the item's words in any order are compared. All documents and all words of them count in every step; there is no cap on
candidates.

Items over 64 words are cut into equal segments, searched apart and added up; where one segment reaches 0.6, all of them
count for that document, however little of them is found. Items are taken in blocks of ``BLOCK``
segments, so what a task holds does not grow with the benchmark; each block is a pass over the documents.

Defined results: items of ``RUN_FROM`` to ``SHORTEST - 1`` words are leaked only by a run of all their words, items of
fewer words are not searched, since ordinary text holds them; a run of characters without spaces is one word. Texts
without words leak nothing. Rows are told apart by doc_id and text: rows that share a doc_id, or have none, count
separately unless their texts are equal; equal rows are one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table, written
from palaver.llm.words import sliced, words_of

PASSAGE = 64
RANK, OVERSAMPLED = 128, 8
RATIO_ALONE, RATIO_WITH_ANSWER, ANSWER_SHARE = 0.8, 0.6, 0.5
LEAST = min(RATIO_ALONE, RATIO_WITH_ANSWER)
SHORTEST, RUN_FROM = 8, 4
SEGMENT = 64
BLOCK = 512
# Regions of a segment begin a sixth of its length apart.
STEPS = 6
SLOT_BITS = 20
# Share of edited copies that a cosine threshold lets through, copies tried for each segment, and the lowest threshold.
RECALL, TRIALS, LOWEST = 0.95, 64, 0.2
# Long texts are handled in pieces of this many words, which share OVERLAP words with the next.
PIECE, OVERLAP = 8192, 256
CHUNK_WORDS = 32_768
# Words of the search, whose block sums are to stay in the cache; terms of the decomposition that are taken as a matrix.
SEARCH_WORDS, USUAL = 8_192, 512
# Rare words of a segment that a region must hold before it is looked at, and their hits that are held together, about.
ANCHORS = 4
PAIRS = 1 << 19


@dataclass
class Segments:
    """Benchmark items of one block, cut into segments; ``first[i]:first[i + 1]`` are the terms of segment ``i``."""

    item: list[int | None]
    part: np.ndarray
    item_words: np.ndarray
    answer_words: np.ndarray
    answer_bits: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    vocabulary: np.ndarray  # word hashes of the terms, sorted
    size: int

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.first)


def answer_of(text: str) -> str:
    """The last sentence or line that holds a word."""
    parts = [p for p in re.split(r"[.!?\n]+(?:\s|$)", text) if re.search(r"\w", p)]
    return parts[-1] if parts else ""


def blocks(items: Iterable[tuple[int | None, str | None]]) -> Iterator[Segments]:
    """Items (id, text) in blocks of about ``BLOCK`` segments."""
    rows: list[tuple] = []
    n = 0
    for item_id, text in items:
        pair = words_of(pa.array([text or "", answer_of(text or "")]))
        words, answer = pair.counts
        if words < RUN_FROM:
            continue
        rows.append((item_id, pair.hashes[:words], int(answer)))
        n += -(-words // SEGMENT)
        if n >= BLOCK:
            yield _segments(rows)
            rows, n = [], 0
    if rows:
        yield _segments(rows)


def _segments(rows: list[tuple]) -> Segments:
    item, part, item_words, answer_words, answer_bits, pieces = [], [], [], [], [], []
    for item_id, hashes, answer in rows:
        cut = np.linspace(0, len(hashes), -(-len(hashes) // SEGMENT) + 1).astype(int)
        for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            bits = sum(1 << i for i in range(b - a) if a + i >= len(hashes) - answer)
            item.append(item_id), part.append(k), item_words.append(len(hashes)), answer_words.append(answer)
            answer_bits.append(bits), pieces.append(hashes[a:b])
    vocabulary, terms = np.unique(np.concatenate(pieces), return_inverse=True)
    first = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    return Segments(
        item, np.array(part), np.array(item_words), np.array(answer_words), np.array(answer_bits, np.uint64), terms,
        first, vocabulary, len(vocabulary),
    )


def term_lookup(vocabulary: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Function from word hashes to places in the sorted vocabulary, -1 for other words; whole hashes are compared."""
    slot = (vocabulary >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    used, first, runs = np.unique(slot, return_index=True, return_counts=True)
    table = np.full(1 << SLOT_BITS, -1, np.int32)
    table[used] = first
    longest = int(runs.max(initial=0))

    def look(hashes: np.ndarray) -> np.ndarray:
        term = table[(hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        at = np.flatnonzero(term >= 0)
        place, found = term[at], np.full(len(at), -1, np.int32)
        for k in range(longest):  # words of one slot stand side by side
            here = np.minimum(place + k, len(vocabulary) - 1)
            found = np.where(vocabulary[here] == hashes[at], here, found)
        term[at] = found
        return term

    return look


def term_type(size: int) -> np.dtype:
    """The numbers in which places of ``size`` terms, and -1, are written."""
    return np.dtype("<i2" if size <= 1 << 15 else "<i4")


def text_key(docs: DataFrame) -> Column:
    """Tells texts of rows with one doc_id, or none, apart."""
    return F.md5(F.coalesce(docs["text"], F.lit("")))


def term_rows(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, key (of the text), own (words that no later row of the text repeats), terms; a row for a piece of a text.

    The terms of a row are the bytes of numbers of ``term_type``, which cost Spark less than an array.
    """
    step, kind = PIECE - OVERLAP, term_type(len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = term_lookup(vocabulary)
        for batch in sliced(batches, "text"):
            words = words_of(batch.column("text"))
            terms = look(words.hashes)
            n = -(-words.counts // step)
            text = np.repeat(np.arange(batch.num_rows), n)
            begin = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * step
            left = words.counts[text] - begin
            size = np.minimum(left, PIECE)
            offsets = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(words.first[:-1][text] + begin - offsets[:-1], size) + np.arange(offsets[-1])
            ends, data = pa.py_buffer((offsets * kind.itemsize).astype(np.int32)), pa.py_buffer(terms[at].astype(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text)), batch.column("key").take(pa.array(text)),
                    pa.array(np.minimum(left, step).astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(text), [None, ends, data]),
                ],
                names=["doc_id", "key", "own", "terms"],
            )

    return on_workers(docs).select(docs["doc_id"].cast("long").alias("doc_id"), text_key(docs).alias("key"), docs["text"]).mapInArrow(
        run, "doc_id long, key string, own int, terms binary"
    )


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of about ``CHUNK_WORDS`` words together: batch, offsets of the rows, terms of a vocabulary of ``size``."""
    kind = term_type(size)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column("terms")
        _, ends, data = column.buffers()
        offsets = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        values = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]].view(kind)
        offsets = (offsets - offsets[0]) // kind.itemsize
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_WORDS, side="right")) - 1)
            yield batch.slice(at, to - at), offsets[at : to + 1] - offsets[at], values[offsets[at] : offsets[to]].astype(np.int32)
            at = to


def _passages(part: pa.RecordBatch, offsets: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Passage and term of every word of the benchmark's vocabulary, and the number of passages; own words only."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(len(terms)) - offsets[row]
    own = part.column("own").to_numpy()
    n = -(-own // PASSAGE)
    passage = (np.cumsum(n) - n)[row] + place // PASSAGE
    keep = (place < own[row]) & (terms >= 0)
    return passage[keep], terms[keep], int(n.sum())


def passage_frequencies(rows: DataFrame, size: int) -> tuple[np.ndarray, int, float]:
    """Passages that hold each term, the number of passages, and the share of all words that are terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total, words, inside = np.zeros(size, np.int64), 0, 0, 0
        for part, offsets, terms in _chunks(batches, size):
            passage, term, n = _passages(part, offsets, terms)
            total, words, inside = total + n, words + len(terms), inside + int((terms >= 0).sum())
            found += np.bincount(np.unique(passage * size + term) % size, minlength=size)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, [-1, -2, -3]).astype(np.int32)), pa.array(np.append(found[at], [total, words, inside]))],
            names=["term", "n"],
        )

    got = on_workers(rows).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = got["term"].to_numpy(), got["n"].to_numpy()
    out = np.zeros(size, np.int64)
    out[term[term >= 0]] = n[term >= 0]
    total, words, inside = (int(n[term == k].sum()) for k in (-1, -2, -3))
    return out, total, inside / max(words, 1)


def latent_terms(rows: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Weighted latent vector of each term: the randomised decomposition of all passages, in one pass."""
    size = len(idf)
    rank, sketch = min(rank, size), min(rank + OVERSAMPLED, size)
    base = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, sketch)))[0]
    names = [f"c{i}" for i in range(sketch)]

    usual = np.argsort(idf, kind="stable")[:USUAL]  # most words of passages are one of few terms: these are a matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A term's weight in a passage is its own weight over the norm of the passage, so sums need none inside.
        out, start = np.zeros((size, sketch), np.float32), (idf[:, None] * base).astype(np.float32)
        column = np.full(size, -1)
        column[usual] = np.arange(len(usual))
        for part, offsets, terms in _chunks(batches, size):
            passage, term, n = _passages(part, offsets, terms)
            norm = np.bincount(passage, idf[term] ** 2, minlength=n)
            at = column[term]
            rare = at < 0
            counts = np.bincount(passage[~rare] * len(usual) + at[~rare], minlength=n * len(usual))
            counts = counts.reshape(n, len(usual)).astype(np.float32)
            sums = counts @ start[usual]
            passage, term = passage[rare], term[rare]
            edge = np.flatnonzero(np.diff(passage, prepend=-1))
            if len(edge):
                sums[passage[edge]] += np.add.reduceat(start[term], edge, axis=0)
            sums /= np.where(norm > 0, norm, 1)[:, None].astype(np.float32)
            out[usual] += counts.T @ sums
            order = np.argsort(term, kind="stable")
            edge = np.flatnonzero(np.diff(term[order], prepend=-1))
            if len(edge):
                out[term[order][edge]] += np.add.reduceat(sums[passage[order]], edge, axis=0)
        out *= idf[:, None].astype(np.float32)
        at = np.flatnonzero(np.abs(out).sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), *[pa.array(np.ascontiguousarray(out[at, i])) for i in range(sketch)]],
            names=["term", *names],
        )

    schema = "term int, " + ", ".join(f"{c} float" for c in names)
    got = on_workers(rows).mapInArrow(run, schema).groupBy("term").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    image = np.zeros((size, sketch))
    image[got["term"].to_numpy()] = np.stack([got[c].to_numpy() for c in names], 1)
    shift = 1e-6 * max(np.linalg.norm(image), 1e-9)
    image += shift * base
    core = base.T @ image
    root = np.linalg.cholesky((core + core.T) / 2 + 1e-12 * np.eye(sketch))
    left, singular, _ = np.linalg.svd(np.linalg.solve(root, image.T).T, full_matrices=False)
    left, singular = left[:, :rank], singular[:rank]
    values = singular**2 - shift
    # Folding in divides by the singular values; directions of rounding errors are left out.
    scale = np.where(values > 10 * shift, np.maximum(values, 1e-12) ** -0.5, 0)
    return (idf[:, None] * left * scale).astype(np.float32)


def _match(regions: np.ndarray, segment: np.ndarray, masks: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Bits of each segment's words that a longest common subsequence with its region adds (bit-parallel rows)."""
    state = full[segment]
    for k in range(regions.shape[1]):
        hit = state & masks[segment, regions[:, k]]
        state = (state + hit) | (state - hit)
    return ~state & full[segment]


@dataclass
class Windows:
    """Segments of like lengths: windows begin every ``step`` words and are ``blocks`` steps long."""

    segments: np.ndarray
    step: int
    blocks: list[int]


def window_classes(lengths: np.ndarray) -> list[Windows]:
    """Segments by length, steps from an eighth to a quarter of it, each the double of the one before."""
    level = np.floor(np.log2(np.maximum(lengths, 1) / 12)).astype(int)
    out = []
    for k in np.unique(np.maximum(level, -1)):
        mine = np.flatnonzero(np.maximum(level, -1) == k)
        step = 3 << int(k) if k >= 0 else 1
        blocks = {max(1, round(f * lengths[mine].mean() / step)) for f in (1, 1.5, 2)}
        out.append(Windows(mine, step, sorted(blocks)))
    return out


def item_vectors(seg: Segments, latent: np.ndarray) -> np.ndarray:
    vectors = np.add.reduceat(latent[seg.terms], seg.first[:-1], axis=0)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def cosine_thresholds(seg: Segments, latent: np.ndarray, frequency: np.ndarray, share: float, seed: int = 11) -> np.ndarray:
    """The cosine that ``RECALL`` of the edited copies of each segment reach, in windows of their length.

    Words between are drawn like those of the corpus: ``share`` of them are terms, by their frequency.
    """
    rng, vectors = np.random.default_rng(seed), item_vectors(seg, latent)
    chance = (frequency + 1) / (frequency + 1).sum()
    out = np.ones(len(seg.item))
    for windows in window_classes(seg.lengths):
        for s in windows.segments:
            words = latent[seg.terms[seg.first[s] : seg.first[s + 1]]]
            n = len(words)
            for kept, blocks in ((LEAST, windows.blocks[0]), (1.0, windows.blocks[-1])):
                keep = rng.random((TRIALS, n)).argsort(axis=1) < int(np.ceil(kept * n - 1e-9))
                others = int(round(share * max(0, blocks * windows.step - keep[0].sum())))
                noise = latent[rng.choice(seg.size, (TRIALS, others), p=chance)].sum(axis=1)
                copies = keep.astype(np.float32) @ words + noise
                cosine = copies @ vectors[s] / np.maximum(np.linalg.norm(copies, axis=1), 1e-9)
                out[s] = min(out[s], np.quantile(cosine, 1 - RECALL))
    return np.maximum(out, LOWEST).astype(np.float32)


def _sliding(x: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """Sums of ``size`` rows in a row, for each size; short of the end by ``size`` - 1.

    They are made of sums over what divides all sizes, times powers of two.
    """
    unit, n = math.gcd(*sizes), len(x)
    powers = [sum((x[k : n - unit + 1 + k] for k in range(1, unit)), x[: n - unit + 1])]
    while 2 * unit << (len(powers) - 1) <= sizes[-1]:
        half = unit << (len(powers) - 1)
        powers.append(powers[-1][:-half] + powers[-1][half:])
    for size in sizes:
        out, done = None, 0
        for k, part in enumerate(powers):
            if size // unit >> k & 1:
                m, part = n - size + 1, part[done:]
                out, done = part[:m] if out is None else out + part[:m], done + (unit << k)
        yield out


def _places(flags: np.ndarray) -> np.ndarray:
    """Flat places of the few flags that are set; eight at once are passed over."""
    flat, whole = flags.ravel(), flags.size // 8 * 8
    some = np.flatnonzero(flat[:whole].view(np.uint64))
    at = np.flatnonzero(flat[:whole].reshape(-1, 8)[some])
    return np.concatenate([some[at >> 3] * 8 + (at & 7), whole + np.flatnonzero(flat[whole:])])


class Search:
    def __init__(self, seg: Segments, latent: np.ndarray, frequency: np.ndarray, threshold: np.ndarray):
        self.seg = seg
        short = seg.item_words < SHORTEST  # searched for a run of all their words
        self.step = np.where(short, 1, np.maximum(1, seg.lengths // STEPS))
        # Begins are a step apart: any stretch of twice the item is inside one region.
        self.region = np.where(short, seg.lengths, 2 * seg.lengths + self.step)
        self.need = np.where(short, seg.lengths, np.ceil(LEAST * seg.lengths - 1e-9).astype(np.int64))
        self._anchors(frequency)
        self.threshold, self.classes = threshold, window_classes(seg.lengths)
        self.latent = np.vstack([latent, np.zeros((1, latent.shape[1]), np.float32)])
        owner = np.repeat(np.arange(len(seg.item)), seg.lengths)
        self.masks = np.zeros((len(seg.item), seg.size + 1), np.uint64)  # the last column is for other words
        bit = np.uint64(1) << (np.arange(len(seg.terms)) - seg.first[owner]).astype(np.uint64)
        np.bitwise_or.at(self.masks, (owner, seg.terms), bit)
        self.full = np.array([(1 << int(n)) - 1 for n in seg.lengths], np.uint64)
        self.vectors = item_vectors(seg, latent)
        self.scaled = self.vectors / threshold[:, None]

    def _anchors(self, frequency: np.ndarray) -> None:
        """The rarest words of each segment: a region with enough of the segment's words holds ``self.least`` of these.

        Words of the segment that may be missing, and ``least`` more; each place of the segment counts.
        """
        lengths = self.seg.lengths
        self.least = np.minimum(ANCHORS, self.need)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        order = np.lexsort((self.seg.terms, frequency[self.seg.terms], owner))
        rank = np.arange(len(order)) - self.seg.first[owner]
        kept = rank < (lengths - self.need + self.least)[owner]
        self.anchor, self.anchor_of = self.seg.terms[order][kept], owner[kept]

    def __call__(self, offsets: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, segment, matched words, matched words of the answer, cosine of the best region of each pair, by_cosine."""
        terms = np.where(terms < 0, self.seg.size, terms)
        found, near = [np.zeros((6, 0), np.int64)], np.concatenate([*self._by_cosine(offsets, terms)], axis=1)
        near = near[:, np.argsort(near[1], kind="stable")]
        for low, high, base, key, gap in self._hits(offsets, terms):
            # Regions of the cosine with fewer anchors hold too few of the segment's words.
            row, segment, begin = near[:, slice(*np.searchsorted(near[1], [low, high]))]
            start = (segment - low) * base + begin + row * gap
            inside = np.searchsorted(key, start + self.region[segment]) - np.searchsorted(key, start)
            held = inside >= self.least[segment]
            others = self._regions(key, base, low, offsets, gap)
            row, segment, begin = np.concatenate([np.stack([row, segment, begin])[:, held], others], axis=1)
            by_cosine = np.arange(len(row)) < np.count_nonzero(held)
            for k in range(0, len(row), 4096):
                part = slice(k, k + 4096)
                found.append(self._verified(row[part], segment[part], begin[part], by_cosine[part], offsets, terms, self.need))
        return self._best(found, offsets, terms)

    def _by_cosine(self, offsets: np.ndarray, terms: np.ndarray) -> Iterator[np.ndarray]:
        """Row, segment and begin of the regions around the windows whose cosine reaches the segment's threshold."""
        at = 0
        while at < len(offsets) - 1:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEARCH_WORDS, side="right")) - 1)
            first = offsets[at]
            for found in self._windows(offsets[at : to + 1] - first, terms[first : offsets[to]]):
                yield found + np.array([[at], [0], [first]])
            at = to

    def _windows(self, offsets: np.ndarray, terms: np.ndarray) -> Iterator[np.ndarray]:
        size = np.diff(offsets)
        # Rows in blocks of the widest step and, of any class, as long as its longest window, so that none reaches the next.
        widest = self.classes[-1].step
        longest = max(w.step * w.blocks[-1] for w in self.classes)
        padded = -(-np.maximum(size, longest) // widest) * widest
        end = np.cumsum(padded)
        words = np.full(int(end[-1]), self.seg.size, terms.dtype)
        words[np.arange(len(terms)) + np.repeat(end - padded - offsets[:-1], size)] = terms
        step, sums = 1, None
        for windows in self.classes:  # each step is a multiple of the one before
            times = windows.step // step
            parts = [words[k::times] if sums is None else sums[k::times] for k in range(times)]
            if sums is None:
                parts = [self.latent.take(x, axis=0) for x in parts]
            step, sums = windows.step, sum(parts[1:], parts[0])
            yield self._near(windows, sums, padded // step, -(-size // step), size, offsets)

    def _near(self, windows, sums, padded, n, size, offsets) -> np.ndarray:
        mine = windows.segments
        row_of = np.repeat(np.arange(len(n)), padded)
        nth = np.arange(len(row_of)) - np.repeat(np.cumsum(padded) - padded, padded)
        keys = []
        for k, x, dots in zip(
            windows.blocks, _sliding(sums, windows.blocks), _sliding(sums @ self.scaled[mine].T, windows.blocks)
        ):
            norm = np.maximum(np.sqrt(np.vecdot(x, x)), np.float32(1e-6))
            # A row shorter than the window is one window.
            norm[nth[: len(x)] > np.maximum(n - k, 0)[row_of[: len(x)]]] = np.inf
            hit, which = np.divmod(_places(dots >= norm[:, None]), len(mine))
            row, segment = row_of[hit], mine[which]
            step, region = self.step[segment], self.region[segment]
            low = nth[hit] * windows.step
            high = np.minimum(low + k * windows.step, size[row])
            for begin in (low // step, -(-np.maximum(high - region, 0) // step)):
                keys.append((row * len(self.seg.item) + segment) * (PIECE + 1) + begin)
        pair, begin = np.divmod(np.unique(np.concatenate(keys)), PIECE + 1)
        row, segment = np.divmod(pair, len(self.seg.item))
        return np.stack([row, segment, offsets[row] + begin * self.step[segment]])

    def whole(self, offsets: np.ndarray, terms: np.ndarray, items: list[list[int]]) -> tuple[np.ndarray, ...]:
        """The same for all segments of the given items of each row (by their first segment), however little is found."""
        terms = np.where(terms < 0, self.seg.size, terms)
        found = [np.zeros((6, 0), np.int64)]
        ends = np.append(np.flatnonzero(self.seg.part == 0), len(self.seg.part))
        for row, size in enumerate(np.diff(offsets)):
            for item in items[row]:
                for s in range(item, ends[np.searchsorted(ends, item, side="right")]):
                    n = max(0, -(-int(size - self.region[s]) // int(self.step[s]))) + 1
                    begin = offsets[row] + np.arange(n) * self.step[s]
                    each = np.full(n, row), np.full(n, s), begin, np.zeros(n, bool)
                    one = self._verified(*each, offsets, terms, np.ones_like(self.need))
                    found.append(one[:, np.lexsort((-one[3], -one[2]))[:1]])
        return self._best(found, offsets, terms)

    def _best(self, found: list[np.ndarray], offsets: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, ...]:
        row, segment, matched, answer, begin, by_cosine = np.concatenate(found, axis=1)
        words, answer_words = self.seg.item_words[segment], self.seg.answer_words[segment]
        with_answer = (matched >= RATIO_WITH_ANSWER * words) & (answer >= ANSWER_SHARE * answer_words)
        passed = (matched >= RATIO_ALONE * words) | with_answer
        order = np.lexsort((begin, -answer, -matched, ~passed, segment, row))
        row, segment = row[order], segment[order]
        best = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(segment, prepend=-1) != 0))
        by_cosine = np.maximum.reduceat(by_cosine[order], best) > 0 if len(best) else by_cosine > 0
        order, row, segment = order[best], row[best], segment[best]
        cosine = [np.zeros(0)]
        for k in range(0, len(row), 256):
            part = slice(k, k + 256)
            cosine.append(self._cosine(row[part], segment[part], begin[order[part]], offsets, terms))
        return row, segment, matched[order], answer[order], np.concatenate(cosine), by_cosine

    def _hits(self, offsets: np.ndarray, terms: np.ndarray) -> Iterator[tuple]:
        """Anchor hits by segment and place, in portions of about ``PAIRS``: segments from, to, and the sorted keys."""
        row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        gap = int(self.region.max())
        place = np.arange(len(terms)) + row_of * gap  # no region reaches into the next row
        order = np.argsort(terms.astype(term_type(self.seg.size + 1)), kind="stable")
        count = np.bincount(terms, minlength=self.seg.size + 1)
        first = np.cumsum(count) - count
        hits = np.concatenate([[0], np.cumsum(count[self.anchor])])
        begins = np.searchsorted(self.anchor_of, np.arange(len(self.seg.item) + 1))  # anchors of each segment
        base, low = gap * (len(offsets) + 1) + len(terms), 0
        while low < len(self.seg.item):
            high = max(low + 1, int(np.searchsorted(hits[begins], hits[begins[low]] + PAIRS, side="right")) - 1)
            high = min(high, len(self.seg.item))
            mine = slice(begins[low], begins[high])
            n = count[self.anchor[mine]]
            at = np.repeat(first[self.anchor[mine]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield low, high, base, np.sort(np.repeat((self.anchor_of[mine] - low) * base, n) + place[order[at]]), gap
            low = high

    def _regions(self, key, base, low, offsets, gap) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The regions in which a sorted hit is the first one and ``least`` hits lie."""
        # Padded places back to places: the row is that whose padded begin is the last one before.
        segment = low + key // base
        last = np.arange(len(key)) + self.least[segment] - 1
        inside = np.flatnonzero(last < len(key))
        close = inside[key[last[inside]] - key[inside] < self.region[segment[inside]]]
        segment, here, end = segment[close], key[close] % base, key[last[close]] % base
        before = np.where(close > 0, key[np.maximum(close - 1, 0)], -1)
        before = np.where(before // base == segment - low, before % base, -1)
        padded = offsets[:-1] + np.arange(len(offsets) - 1) * gap
        row = np.searchsorted(padded, here, side="right") - 1
        start, size = padded[row], np.diff(offsets)[row]
        step, region = self.step[segment], self.region[segment]
        least = np.maximum(np.maximum(before + 1, end - region + 1) - start, 0)
        lowest = -(-least // step)
        highest = np.minimum((here - start) // step, np.maximum(0, -(-(size - region) // step)))
        n = np.maximum(highest - lowest + 1, 0)
        nth = np.repeat(lowest - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(row, n), np.repeat(segment, n), offsets[np.repeat(row, n)] + nth * np.repeat(step, n)

    def _verified(self, row, segment, begin, by_cosine, offsets, terms, need) -> np.ndarray:
        """Row, segment, matched words, matched answer words, begin and source of the regions that can be a leak."""
        regions = self._words(row, segment, begin, offsets, terms)
        # No common subsequence is longer than the number of the segment's words that the region holds.
        present = np.bitwise_or.reduce(self.masks[segment[:, None], regions], axis=1)
        full = np.flatnonzero(np.bitwise_count(present) >= need[segment])
        row, segment, begin, by_cosine, regions = row[full], segment[full], begin[full], by_cosine[full], regions[full]
        bits = _match(regions, segment, self.masks, self.full)
        matched = np.bitwise_count(bits).astype(np.int64)
        answer = np.bitwise_count(bits & self.seg.answer_bits[segment]).astype(np.int64)
        return np.stack([row, segment, matched, answer, begin, by_cosine])[:, matched >= need[segment]]

    def _words(self, row, segment, begin, offsets, terms) -> np.ndarray:
        ahead = np.arange(int(self.region[segment].max(initial=0)))
        place = begin[:, None] + ahead
        inside = (place < offsets[row + 1][:, None]) & (ahead < self.region[segment][:, None])
        return np.where(inside, terms[np.where(inside, place, 0)], self.seg.size)

    def _cosine(self, row, segment, begin, offsets, terms) -> np.ndarray:
        """The highest cosine of a window as long as the segment inside each region."""
        vectors = self.latent[self._words(row, segment, begin, offsets, terms)]
        total = np.concatenate([np.zeros_like(vectors[:, :1]), np.cumsum(vectors, axis=1)], axis=1)
        best, each, length = np.zeros(len(row)), np.arange(len(row)), self.seg.lengths[segment]
        for k in range(2 * STEPS + 4):
            low = np.minimum(k * self.step[segment], self.region[segment] - length)
            x = total[each, low + length] - total[each, low]
            dot = np.einsum("ij,ij->i", x, self.vectors[segment])
            best = np.maximum(best, dot / np.maximum(np.linalg.norm(x, axis=1), 1e-9))
        return best


FOUND = (
    "doc_id long, key string, item_id long, item int, segment int, words long, answer_words long, matched long, "
    "answer long, cosine double, by_cosine boolean"
)


def search(
    rows: DataFrame, seg: Segments, latent: np.ndarray, frequency: np.ndarray, threshold: np.ndarray
) -> DataFrame:
    """Common subsequences of document pieces and item segments with ``LEAST`` of the segment's words or more.

    Where ``rows`` name items (``items``, by their first segments), those of all their segments instead.
    """
    named = "items" in rows.columns
    first = np.maximum.accumulate(np.where(seg.part == 0, np.arange(len(seg.part)), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Search(seg, latent, frequency, threshold)
        items = pa.array(seg.item, pa.int64())
        for part, offsets, terms in _chunks(batches, seg.size):
            got = find.whole(offsets, terms, part.column("items").to_pylist()) if named else find(offsets, terms)
            row, segment, matched, answer, cosine, by_cosine = got
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(row)), part.column("key").take(pa.array(row)), items.take(pa.array(segment)),
                    pa.array(first[segment].astype(np.int32)), pa.array(seg.part[segment].astype(np.int32)),
                    pa.array(seg.item_words[segment]), pa.array(seg.answer_words[segment]), pa.array(matched),
                    pa.array(answer), pa.array(cosine), pa.array(by_cosine),
                ],
                names=[f.split()[0] for f in FOUND.split(", ")],
            )

    return on_workers(rows).mapInArrow(run, FOUND)


LEAKS = (
    "doc_id", "item_id", "words", "matched", "answer_words", "answer", "ratio", "cosine", "by_cosine", "key"
)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id) of every leak, with the words of the item and of its answer that are found, the cosine, whether
    the cosine search led to it, and the key of the text."""
    found = None
    for seg in blocks((r[0], r[1]) for r in benchmark.select("item_id", "text").toLocalIterator()):
        rows = written(term_rows(docs, seg.vocabulary), "terms")
        df, total, share = passage_frequencies(rows, seg.size)
        idf = 1 + np.log((1 + total) / (1 + df))  # positive for every term, however common it is
        latent = latent_terms(rows, idf)
        threshold = cosine_thresholds(seg, latent, df, share)
        part = written(search(rows, seg, latent, df, threshold), "found")
        found = part if found is None else found.unionByName(part)
        if seg.part.any():
            # An item of several segments can be a leak if one of them has LEAST of its words; the others count too.
            named = part.filter(F.col("words") > SEGMENT).groupBy(
                F.col("doc_id").alias("_doc"), F.col("key").alias("_key")
            ).agg(F.collect_set("item").alias("items"))
            same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key"))
            again = rows.join(named, same).select(*rows.columns, "items")
            found = found.unionByName(written(search(again, seg, latent, df, threshold), "found"))
    if found is None:
        empty = "doc_id long, item_id long, words long, matched long, answer_words long, answer long, ratio double"
        return docs.sparkSession.createDataFrame([], empty + ", cosine double, by_cosine boolean, key string")
    best = found.groupBy("doc_id", "key", "item_id", "segment", "words", "answer_words").agg(
        F.max(F.struct(_leaked(), "matched", "answer", "cosine")).alias("b"), F.max("by_cosine").alias("by_cosine")
    )
    whole = best.groupBy("doc_id", "key", "item_id", "words", "answer_words").agg(
        F.sum("b.matched").alias("matched"), F.sum("b.answer").alias("answer"), F.max("b.cosine").alias("cosine"),
        F.max("by_cosine").alias("by_cosine"),
    ).withColumn("ratio", F.col("matched") / F.col("words"))
    return whole.filter(_leaked()).select(*LEAKS)


def _leaked() -> Column:
    ratio = F.col("matched") / F.col("words")
    with_answer = (ratio >= RATIO_WITH_ANSWER) & (F.col("answer") >= ANSWER_SHARE * F.col("answer_words"))
    return (ratio >= RATIO_ALONE) | with_answer


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """Leaks of benchmark items in documents: doc_id, item_id, matched words, ratio, cosine, by_cosine."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(*LEAKS[:-1])


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in whose text no benchmark item leaked."""
    found = leaks(docs, table(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(leaked["_doc"]) & (text_key(docs) == leaked["_key"])
    return docs.join(leaked, same, "left_anti")
