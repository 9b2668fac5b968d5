"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is coded as its tokens: each word (a run without blanks, A-Z lower-cased) followed by one blank, and a blank in the
place of a word as the end. Every byte is eight binary decisions; a decision is taken at a node, which is a context (the
``DEPTH`` bytes before, or fewer) and the bits of the byte so far. From the counts a, b of zeros and ones at a node, its
Krichevsky-Trofimov estimate gives the probability P_e of all its decisions; its weighted probability is

    P_w = P_e                                     for contexts of DEPTH bytes,
    P_w = 1/2 P_e + 1/2 product of P_w of the contexts that are one byte longer

so that every pruning of the context tree takes part with its weight. The probability of a decision mixes the estimates
(a + 1/2) / (a + b + 1) of the contexts of all lengths, where a context stops the mixture with the share 1/2 P_e / P_w. The
longest context that was ever seen takes all that is left. Counts are frozen: texts are scored by what the training
texts taught, and the probabilities of the 256 bytes add up to one in every context.

Distribution. A cell is a full context with its byte; tasks count the cells of their texts, and the counts of all texts are
added up by cell. The ``LOCAL`` deepest levels of the tree are worked out by numpy for all cells of a shorter context (at
most 2**24 of them). Above, nodes are rows, and a level is the sum over the next one by groups of at most 256 children; the
mixture goes back down by joins with the parent. So every cell of the corpus gets its code length once. Texts are then
scored: frequent cells and words are looked up in the task, the rest by a join.

Base score: log10 of (c + 1) / (N + V + 1) over the tokens, c being the training count of the token.

Defined results: a null or empty text is its end alone. A null doc_id is learned from and not held out. Repeated rows
are learned and scored each. Without training texts all estimates are 1/2 and the base score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table, written
from palaver.llm.frequent import frequent
from palaver.llm.words import CHUNK_BYTES, plain_array, sliced, string_buffers

DEPTH = 5
# The deepest levels that a task works out by itself, for all cells that share the shorter context.
LOCAL = 2
# Distinct cells, and words, that a task gathers before it hands them on.
CELLS_TOGETHER, WORDS_TOGETHER = 1 << 21, 1 << 19
# Cells and words that are broadcast, at most.
FREQUENT_CELLS, FREQUENT_WORDS = 1 << 20, 1 << 16
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_WORDS_IN_BLOCK = CHUNK_BYTES // 8
# Texts of more bytes are coded in blocks.
LONG = 4 * CHUNK_BYTES
# Bytes as they are coded: A-Z lower-cased, every blank as a space.
_CODED = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\v\f\r", b" " * 5)), np.uint8)


def is_held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_blocks(text: str | None) -> Iterator[tuple[list[bytes], bool]]:
    """Words of a text in blocks, with True at the last one. There is at least one block."""
    found = (m.group() for m in _WORD.finditer((text or "").encode().lower()))  # bytes: A-Z only
    block = list(islice(found, _WORDS_IN_BLOCK))
    while True:
        following = list(islice(found, _WORDS_IN_BLOCK))
        yield block, not following
        if not following:
            return
        block = following


def cells_of(text: str | None, depth: int = DEPTH) -> Iterator[np.ndarray]:
    """Cells of a text, block by block: the nearest byte of the context is the highest, the byte itself the lowest."""
    before = b" " * depth
    for block, last in word_blocks(text):
        coded = before + b"".join(w + b" " for w in block) + (b" " if last else b"")
        data = np.frombuffer(coded, np.uint8).astype(np.int64)
        out = data[depth:].copy()
        for back in range(1, depth + 1):
            out |= data[depth - back : len(data) - back] << (8 * (depth - back + 1))
        before = coded[len(coded) - depth :]
        yield out


def coded(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coded bytes of several texts in a row, ``depth`` blanks before each; the first byte and the words of each."""
    offsets, raw = string_buffers(plain_array(texts))
    data = _CODED[raw]
    blank = data == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # of a run of blanks the first
    filled = np.flatnonzero(np.diff(offsets))
    keep[offsets[filled]] = ~blank[offsets[filled]]
    unclosed = np.zeros(len(texts), np.int64)
    unclosed[filled] = ~blank[offsets[filled + 1] - 1]
    kept, words = (np.concatenate([[0], np.cumsum(x)])[offsets] for x in (keep, keep & blank))
    first = np.concatenate([[0], np.cumsum(np.diff(kept) + unclosed + depth + 1)])
    out = np.full(first[-1], 32, np.uint8)
    out[np.arange(kept[-1]) + np.repeat(first[:-1] + depth - kept[:-1], np.diff(kept))] = data[keep]
    return out, first, np.diff(words) + unclosed


def batch_cells(batch: pa.RecordBatch, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells of the texts of a batch, and the text of each; a very long text comes in blocks."""
    if batch.column("text").nbytes > LONG:
        for i, text in enumerate(batch.column("text")):
            for cells in cells_of(text.as_py(), depth):
                yield cells, np.full(len(cells), i)
        return
    data, first, _ = coded(batch.column("text"), depth)
    inside = np.ones(len(data), bool)
    inside[(first[:-1, None] + np.arange(depth)).reshape(-1)] = False
    wide = data.astype(np.int64)
    cells = wide.copy()
    for back in range(1, depth + 1):
        cells[depth:] |= wide[depth - back : len(wide) - back] << (8 * (depth - back + 1))
    yield cells[inside], np.repeat(np.arange(batch.num_rows), np.diff(first) - depth)


def batch_words(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of the texts of a batch, and the text of each."""
    if batch.column("text").nbytes > LONG:
        for i, text in enumerate(batch.column("text")):
            for block, _ in word_blocks(text.as_py()):
                yield block, np.full(len(block), i)
        return
    data, _, words = coded(batch.column("text"), 0)
    yield data.tobytes().split(), np.repeat(np.arange(batch.num_rows), words)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _tally(marked: list[np.ndarray], known: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add occurrences to sorted keys with counts."""
    values = np.sort(np.concatenate(marked)) if marked else np.zeros(0, np.int64)
    first = _runs(values)
    both = np.concatenate([known, values[first]])
    order = np.argsort(both, kind="stable")  # two sorted runs are merged in one go
    both, counts = both[order], np.concatenate([sums, np.diff(np.append(first, len(values)))])[order]
    first = _runs(both)
    return both[first], np.add.reduceat(counts, first) if len(first) else counts


def cell_counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """cell, n (in training texts) and total (in all texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(marked: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            cell, held = marked >> 1, marked & 1
            first = _runs(cell)
            n, total = (np.add.reduceat(x, first) if len(first) else x for x in (count * (1 - held), count))
            return pa.RecordBatch.from_arrays([pa.array(cell[first]), pa.array(n), pa.array(total)], names=["cell", "n", "total"])

        # Keys are the cell and a last bit for held-out texts.
        known, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        marked: list[np.ndarray] = []
        for batch in sliced(batches, "text"):
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(np.int64)
            for cells, text in batch_cells(batch, depth):
                marked.append(cells << 1 | held[text])
                if sum(map(len, marked)) > 4 * CHUNK_BYTES:
                    known, sums = _tally(marked, known, sums)
                    marked = []
                    if len(known) > CELLS_TOGETHER:
                        yield out(known, sums)
                        known, sums = known[:0], sums[:0]
        yield out(*_tally(marked, known, sums))

    parts = on_workers(docs).select("text", "held_out").mapInArrow(run, "cell long, n long, total long")
    return parts.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def word_counts(docs: DataFrame) -> DataFrame:
    """word and c, of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "c"]
            )

        seen: Counter = Counter()
        for batch in sliced(batches, "text"):
            for block, _ in batch_words(batch):
                seen.update(block)
                if len(seen) > WORDS_TOGETHER:
                    yield out(seen)
                    seen = Counter()
        yield out(seen)

    parts = on_workers(docs.filter("NOT held_out")).select("text").mapInArrow(run, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def log_gamma(x, log):
    """Natural logarithm of the gamma function of columns or arrays above 0: Stirling's series eight steps up, and back."""
    y = x + 8.0
    series = (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi)
    # Bernoulli numbers B(2k) / (2k (2k - 1)), fixed values.
    for k, factor in enumerate((1 / 12, -1 / 360, 1 / 1260, -1 / 1680)):
        series = series + factor * y ** (-2.0 * k - 1)
    steps = x
    for i in range(1, 8):
        steps = steps * (x + float(i))
    return series - log(steps)


def log_estimate(a, b, log):
    """log P_e of a zeros and b ones (columns or arrays)."""
    return log_gamma(a + 0.5, log) + log_gamma(b + 0.5, log) - math.log(math.pi) - log_gamma(a + b + 1.0, log)


class Nodes(NamedTuple):
    """Nodes of one depth as arrays, sorted by key: the context followed by the bits so far (with a leading 1)."""

    key: np.ndarray
    a: np.ndarray
    b: np.ndarray
    log_w: np.ndarray
    stop: np.ndarray
    parent_of: np.ndarray  # for each node one byte deeper (for each cell and bit at the full depth), the place of its own


def deep_nodes(cell: np.ndarray, n: np.ndarray) -> list[Nodes]:
    """Nodes of the ``LOCAL`` + 1 deepest levels from whole groups of cells, the shallowest first."""
    byte = cell & 255
    key = np.concatenate([cell >> 8 << 8 | (256 | byte) >> (8 - level) for level in range(8)])
    bit = np.concatenate([byte >> (7 - level) & 1 for level in range(8)])
    count = np.tile(n, 8).astype(float)
    key, place = np.unique(key, return_inverse=True)
    a, b = (np.bincount(place, count * x, minlength=len(key)) for x in (1 - bit, bit))
    out = [Nodes(key, a, b, log_estimate(a, b, np.log), np.ones(len(key)), place)]
    for _ in range(LOCAL):
        low = out[0]
        key, place = np.unique(low.key >> 16 << 8 | low.key & 255, return_inverse=True)
        a, b, longer = (np.bincount(place, x, minlength=len(key)) for x in (low.a, low.b, low.log_w))
        own = log_estimate(a, b, np.log)
        log_w = np.logaddexp(own, longer) - math.log(2)
        out.insert(0, Nodes(key, a, b, log_w, np.exp(own - log_w - math.log(2)), place))
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``base``, joined and cut so that no base is in two; a base has 2**24 cells at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        base = batch.column("base").to_numpy()
        cut = int(np.searchsorted(base, base[-1]))  # the last base may go on in the next batch
        begun = held[-1].column("base")[-1].as_py() if held else None
        if begun is not None and (cut or begun != base[-1]) and sum(h.num_rows for h in held) > 1 << 18:
            end = int(np.searchsorted(base, begun, side="right"))
            yield pa.concat_batches([*held, batch.slice(0, end)])
            held, batch = [], batch.slice(end)
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _whole_groups(batches):
        top = deep_nodes(batch.column("cell").to_numpy(), batch.column("n").to_numpy())[0]
        counts = [pa.array(x.astype(np.int64)) for x in (top.key >> 8, top.key & 255, top.a, top.b)]
        yield pa.RecordBatch.from_arrays(
            [*counts, pa.array(top.log_w), pa.array(top.stop)], names=["context", "prefix", "a", "b", "log_w", "stop"]
        )


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of cells, and of the states of their shallowest nodes, to code lengths."""
    for batch in _whole_groups(batches):
        is_cell = batch.column("prefix").is_null().to_numpy(zero_copy_only=False)
        cells, states = batch.filter(pa.array(is_cell)), batch.filter(pa.array(~is_cell))
        cell = cells.column("cell").to_numpy()
        levels = deep_nodes(cell, cells.column("n").to_numpy())
        key = states.column("base").to_numpy() << 8 | states.column("prefix").to_numpy()
        place = np.argsort(key)
        part, rest, last = (states.column(c).to_numpy()[place] for c in ("part", "rest", "last"))
        for above, nodes in zip(levels, levels[1:]):
            part, rest, last = (x[above.parent_of] for x in (part, rest, last))
            seen, own = nodes.a + nodes.b > 0, (nodes.b + 0.5) / (nodes.a + nodes.b + 1)
            part = np.where(seen, part + rest * nodes.stop * own, part)
            rest, last = np.where(seen, rest * (1 - nodes.stop), rest), np.where(seen, own, last)
        one = (part + rest * last)[levels[-1].parent_of].reshape(8, -1)
        byte = cell & 255
        bit = np.stack([byte >> (7 - level) & 1 for level in range(8)]) == 1
        logs = np.log10(np.where(bit, one, 1 - one)).sum(0)
        yield pa.RecordBatch.from_arrays(
            [cells.column("cell"), cells.column("total"), pa.array(logs)], names=["cell", "total", "log10"]
        )


def _by_base(rows: DataFrame) -> DataFrame:
    return on_workers(rows).repartition("base").sortWithinPartitions("base")


def node_levels(counted: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """Nodes of depth 0 to ``depth`` - ``LOCAL``: context, prefix, a, b and stop, the share of the mixture that ends here."""
    cells = counted.select(F.shiftright("cell", 8 * (LOCAL + 1)).alias("base"), "cell", "n")
    nodes = _by_base(cells).mapInArrow(_up, "context long, prefix long, a long, b long, log_w double, stop double")
    levels = [written(nodes, "nodes")]
    for _ in range(depth - LOCAL):
        nodes = levels[0].groupBy(F.shiftright("context", 8).alias("context"), "prefix").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("log_w").alias("longer")
        )
        nodes = nodes.withColumn("own", log_estimate(F.col("a"), F.col("b"), F.log))
        high, low = F.greatest("own", "longer"), F.least("own", "longer")
        nodes = nodes.withColumn("log_w", high + F.log1p(F.exp(low - high)) - math.log(2))
        stop = F.exp(F.col("own") - F.col("log_w") - math.log(2))
        levels.insert(0, written(nodes.select("context", "prefix", "a", "b", "log_w", stop.alias("stop")), "nodes"))
    return levels


def states(levels: list[DataFrame]) -> DataFrame:
    """base (context), prefix and the mixture down to the deepest of the levels: part done, share left, last estimate."""
    own, seen = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1), F.col("a") + F.col("b") > 0
    part, rest, last = F.lit(0.0), F.lit(1.0), F.lit(0.5)
    state = None
    for nodes in levels:
        if state is not None:
            above = state.select(F.col("base").alias("_up"), "prefix", *[F.col(c).alias(f"_{c}") for c in ("part", "rest", "last")])
            nodes = nodes.withColumn("_up", F.shiftright("context", 8)).join(above, ["_up", "prefix"])
            part, rest, last = F.col("_part"), F.col("_rest"), F.col("_last")
        state = nodes.select(
            F.col("context").alias("base"), "prefix",
            F.when(seen, part + rest * F.col("stop") * own).otherwise(part).alias("part"),
            F.when(seen, rest * (1 - F.col("stop"))).otherwise(rest).alias("rest"),
            F.when(seen, own).otherwise(last).alias("last"),
        )
    return state


def code_lengths(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """cell, total and log10 of the probability of the byte in its context."""
    above = states(node_levels(counted, depth))
    cells = counted.withColumn("base", F.shiftright("cell", 8 * (LOCAL + 1)))
    both = cells.unionByName(above, allowMissingColumns=True)
    return _by_base(both).mapInArrow(_down, "cell long, total long, log10 double")


def scores(
    docs: DataFrame, depth: int = DEPTH, most_cells: int = FREQUENT_CELLS, most_words: int = FREQUENT_WORDS
) -> DataFrame:
    """doc_id, held_out, tokens, base score and score of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("held_out", is_held_out())
    counted = written(cell_counts(docs, depth), "cells")
    cells = written(code_lengths(counted, depth), "lengths")
    vocabulary = written(word_counts(docs), "words")
    sums = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = docs.filter("NOT held_out").count()
    n, v = sums.n + ends, sums.v + (ends > 0)

    common_cells = frequent(cells, "total", most_cells).select("cell", "log10").orderBy("cell").toArrow()
    known, lengths = common_cells.column("cell").to_numpy(), common_cells.column("log10").to_numpy()
    common_words = frequent(vocabulary, "c", most_words).toArrow()
    words = {w: i for i, w in enumerate(common_words.column("word").to_pylist())}
    share = n + v + 1
    by_word = np.log10((np.append(common_words.column("c").to_numpy(), 0) + 1) / share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            many, rows = batch.num_rows, batch.column("row").to_numpy()
            tokens, in_vocabulary = np.ones(many, np.int64), np.full(many, int(ends > 0))
            base, score, size = np.full(many, math.log10((ends + 1) / share)), np.zeros(many), np.zeros(many, np.int64)
            for block, text in batch_words(batch):
                at = np.fromiter(map(words.get, block, repeat(-1)), np.int64, len(block))
                tokens += np.bincount(text, minlength=many)
                in_vocabulary += np.bincount(text[at >= 0], minlength=many)
                base += np.bincount(text[at >= 0], by_word[at[at >= 0]], minlength=many)
                late = np.flatnonzero(at < 0)
                rare = Counter(zip(text[late].tolist(), map(block.__getitem__, late.tolist())))
                yield _found(
                    2, rows[np.array([t for t, _ in rare], np.int64)], word=[w for _, w in rare], times=list(rare.values())
                )
            for cells, text in batch_cells(batch, depth):
                size += np.bincount(text, minlength=many)
                order = np.argsort(cells)
                cells, text = cells[order], text[order]
                first = _runs(cells)
                at = np.minimum(np.searchsorted(known, cells[first]), max(len(known) - 1, 0))
                hit = known[at] == cells[first] if len(known) else np.zeros(len(first), bool)
                values = np.zeros(len(first))
                values[hit] = lengths[at[hit]]
                times = np.diff(np.append(first, len(cells)))
                score += np.bincount(text, np.repeat(values, times), minlength=many)
                late = np.flatnonzero(np.repeat(~hit, times))
                yield _found(1, rows[text[late]], cell=cells[late], times=np.ones(len(late), np.int64))
            yield _found(
                0, rows, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), n_tokens=tokens,
                n_known=in_vocabulary, bytes=size, base_score=base, score=score,
            )

    numbered = on_workers(docs).withColumn("row", F.monotonically_increasing_id())
    found = written(numbered.mapInArrow(run, _FOUND), "scored")
    lookup = found.filter("kind = 1").join(cells.select("cell", "log10"), "cell").groupBy("row").agg(
        F.sum(F.col("times") * F.col("log10")).alias("late_score")
    )
    c = F.coalesce("c", F.lit(0))
    late = found.filter("kind = 2").join(vocabulary, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(share)))).alias("late_base"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("late_known"),
    )
    rows = found.filter("kind = 0").join(lookup, "row", "left").join(late, "row", "left")
    score = F.col("score") + F.coalesce("late_score", F.lit(0.0))
    return rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("late_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("late_base", F.lit(0.0))).alias("base_score"), score.alias("score"),
        (-score / F.col("bytes") / math.log10(2)).alias("bits_per_byte"),
    )


# Kind 0: a text; 1: its cells that are not frequent; 2: its words that are not.
_FOUND = (
    "kind int, row long, doc_id long, held_out boolean, n_tokens long, n_known long, bytes long, base_score double, "
    "score double, cell long, word binary, times long"
)
_TYPES = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}


def _found(kind: int, rows: np.ndarray, **columns) -> pa.RecordBatch:
    """Rows of one kind; the columns of other kinds are null."""
    columns |= {"kind": np.full(len(rows), kind, np.int32), "row": rows}
    names, types = zip(*(c.split() for c in _FOUND.split(", ")))
    arrays = []
    for name, kind_of in zip(names, types):
        values = columns.get(name)
        arrays.append(
            pa.nulls(len(rows), _TYPES[kind_of]) if values is None
            else values if isinstance(values, pa.Array) else pa.array(values, _TYPES[kind_of])
        )
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def op12_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Context-tree and unigram score of every document."""
    return scores(table(spark, sf_dir, "documents"))
