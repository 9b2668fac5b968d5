"""Alignment of two tokenizers over the corpus, with exact-text deduplication.

Rows are shuffled by their full text and each distinct text is tokenised and aligned once. Tokenizer A is the byte-level
vocabulary, B the piece vocabulary; both encode space + text, so that their tokens cover the same bytes. The offsets where
tokens of both end cut the bytes into groups. Between two neighbouring token ends of either side lies exactly one pair of
tokens that overlap, so the merged ends of a text are its links.

The count of an id pair is the number of documents that hold it linked: each distinct text adds its multiplicity, summed
map-side first. A pair is best for its A id if no other pair of that id has a higher count. Measures of texts take the
counts of frequent pairs from arrays in the task and those of all others by a join; they reach documents by the digest of
the text, where texts that hold more than a ``SHARE``-th of all rows (so fewer than ``SHARE``) are broadcast.

Defined results: a null or empty text, and one whose tokens do not give back its bytes (say, because it holds the piece
vocabulary's mark of a space), has no tokens: zeros and an empty digest of groups. It adds to no count. Names of special
tokens in a text are text. Repeated rows, with or without doc_id, count as documents and are returned each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table, written
from palaver.llm.frequent import FREQUENT, frequent
from palaver.llm.tokens import encoder
from palaver.llm.words import sliced

PIECES = "piece_bpe_32k.model"
# B ids fit below.
B_BITS = 15
SHARE = 1024
MEASURES = ["n_a", "n_b", "n_groups", "n_links"]


class Pieces:
    """Token ids of the piece vocabulary, and the bytes that each stands for."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path or public_tokenizers.path(PIECES))
        self.bytes = [self._bytes(i) for i in range(self.model.vocab_size())]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=1)
def pieces(path: str | None = None) -> Pieces:
    """One for each Python worker."""
    return Pieces(path)


@lru_cache(maxsize=1)
def _numerals() -> dict[str, np.ndarray]:
    """Ids as decimal text behind each of the separators."""
    return {mark: np.array([f"{mark}{i}" for i in range(1 << 16)], object) for mark in ",|;"}


def group_texts(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray) -> list[str]:
    """Tokens in the order of groups, A before B, each behind its separator: ``;`` a group, ``|`` its B part, ``,`` else."""
    ids, group = np.concatenate([a, b]), np.concatenate([group_a, group_b])
    is_b = np.repeat([False, True], [len(a), len(b)])
    order = np.argsort(group * 2 + is_b, kind="stable")
    ids, group, is_b = ids[order], group[order], is_b[order]
    opens, turns = np.ones(len(ids), bool), np.zeros(len(ids), bool)
    opens[1:] = group[1:] != group[:-1]
    turns[1:] = is_b[1:] & ~is_b[:-1]
    out = _numerals()[","][ids]
    out[turns] = _numerals()["|"][ids[turns]]
    out[opens] = _numerals()[";"][ids[opens]]
    return out.tolist()


def align(texts: list[str], path_a: str | None = None, path_b: str | None = None) -> list[tuple]:
    """n_a, n_b, n_groups, n_links, digest of groups, distinct pairs and their links, for each of the texts."""
    ea, eb = encoder(path_a), pieces(path_b)
    ids_b = eb.ids(texts)
    tokens_a, tokens_b, good = [], [], []
    for text, b in zip(texts, ids_b):
        raw = (" " + text).encode()
        a = ea.ids(" " + text).astype(np.int64) if text else np.zeros(0, np.int64)
        good.append(bool(text) and ea.lengths[a].sum() == len(raw) and b"".join([eb.bytes[i] for i in b]) == raw)
        tokens_a.append(a if good[-1] else a[:0])
        tokens_b.append(np.array(b if good[-1] else [], np.int64))
    a, b = np.concatenate(tokens_a), np.concatenate(tokens_b)
    n_a, n_b = (np.array([len(t) for t in side]) for side in (tokens_a, tokens_b))
    # Ends over all texts in a row; a text's end is an end of both sides, so texts never share a group.
    end_a, end_b = np.cumsum(ea.lengths[a]), np.cumsum(eb.lengths[b])
    shared, ends = np.intersect1d(end_a, end_b), np.union1d(end_a, end_b)
    link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    text_of_a = np.repeat(np.arange(len(texts)), n_a)
    text_of_link = text_of_a[link_a]
    n_links = np.bincount(text_of_link, minlength=len(texts))
    n_groups = np.bincount(text_of_a[np.searchsorted(end_a, shared)], minlength=len(texts))
    pair = a[link_a] << B_BITS | b[link_b]
    both, times = np.unique(text_of_link << 32 | pair, return_counts=True)
    cut = np.searchsorted(both, np.arange(len(texts) + 1) << 32)
    marked = group_texts(a, np.searchsorted(shared, end_a), b, np.searchsorted(shared, end_b))
    at = np.concatenate([[0], np.cumsum(n_a + n_b)])
    out = []
    for i in range(len(texts)):
        groups = "".join(marked[at[i] : at[i + 1]])[1:]
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        found = slice(cut[i], cut[i + 1])
        pairs = (both[found] & ((1 << 32) - 1)).astype(np.int32)
        out.append((n_a[i], n_b[i], n_groups[i], n_links[i], digest, pairs, times[found].astype(np.int32)))
    return out


def _text_key() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def aligned_texts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row for each distinct text: key, copies (its multiplicity), measures, distinct pairs and their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rows = align(batch.column("text").to_pylist(), path_a, path_b)
            arrays = [pa.array([int(r[i]) for r in rows], pa.int64()) for i in range(4)]
            first = pa.array(np.concatenate([[0], np.cumsum([len(r[5]) for r in rows])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(first, pa.array(np.concatenate([r[i] for r in rows]))) for i in (5, 6)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copies"), *arrays, pa.array([r[4] for r in rows]), *lists],
                names=["key", "copies", *MEASURES, "groups_sha256", "pairs", "links"],
            )

    distinct = docs.filter("text IS NOT NULL").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return on_workers(distinct).select(_text_key().alias("key"), "copies", "text").mapInArrow(
        run,
        "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<int>, links array<int>",
    )


def pair_counts(texts: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked) and best (whether no pair of its A id has more)."""
    each = texts.select(F.explode("pairs").alias("pair"), "copies")
    counts = written(each.groupBy("pair").agg(F.sum("copies").alias("n")), "pairs")
    of_a = F.shiftright("pair", B_BITS).alias("a")
    # One row for each id of the vocabulary.
    highest = counts.groupBy(of_a).agg(F.max("n").alias("high"))
    return counts.select(of_a, "pair", "n").join(F.broadcast(highest), "a").select(
        "pair", "n", (F.col("n") == F.col("high")).alias("best")
    )


def counted_links(texts: DataFrame, counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """id, n_best and count_sum of the texts (id, pairs, links)."""
    top = frequent(counts, "n", most).orderBy("pair").toArrow()
    known, n, best = (top.column(c).to_numpy() for c in ("pair", "n", "best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("pairs").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            pair, links = (batch.column(c).flatten().to_numpy() for c in ("pairs", "links"))
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row[hit], links[hit] * best[at[hit]])
            np.add.at(sums[1], row[hit], links[hit] * n[at[hit]])
            ids = batch.column("id").to_numpy()
            none, late = batch.num_rows, int((~hit).sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids, ids[row[~hit]]])),
                    pa.array([None] * none + pair[~hit].tolist(), pa.int32()),
                    pa.array([None] * none + links[~hit].tolist(), pa.int32()),
                    pa.array(np.concatenate([sums[0], np.zeros(late, np.int64)])),
                    pa.array(np.concatenate([sums[1], np.zeros(late, np.int64)])),
                ],
                names=["id", "pair", "links", "n_best", "count_sum"],
            )

    schema = "id long, pair int, links int, n_best long, count_sum long"
    found = written(on_workers(texts).select("id", "pairs", "links").mapInArrow(run, schema), "links")
    links = F.col("links").cast("long")
    late = found.filter("pair IS NOT NULL").select("id", "pair", "links").join(counts, "pair").select(
        "id", F.when(F.col("best"), links).otherwise(0).alias("n_best"), (links * F.col("n")).alias("count_sum")
    )
    rows = found.filter("pair IS NULL").select("id", "n_best", "count_sum").unionByName(late)
    return rows.groupBy("id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most: int = FREQUENT) -> DataFrame:
    """doc_id, measures and digest of groups of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = written(aligned_texts(docs, path_a, path_b).withColumn("id", F.monotonically_increasing_id()), "texts")
    counts = written(pair_counts(texts), "counts")
    links = counted_links(texts, counts, most)
    columns = [*MEASURES, "n_best", "count_sum"]
    measures = written(texts.join(links, "id").select("key", "copies", *columns, "groups_sha256"), "measures")

    rows = measures.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.col("copies") * SHARE > rows
    keyed = docs.select("doc_id", _text_key().alias("key"))
    few = F.broadcast(measures.filter(hot))
    done = keyed.join(few, "key").select("doc_id", *columns, "groups_sha256")
    other = keyed.filter("key IS NOT NULL").join(F.broadcast(measures.filter(hot).select("key")), "key", "left_anti")
    done = done.unionByName(other.join(measures.filter(~hot), "key").select("doc_id", *columns, "groups_sha256"))
    zeros = [F.lit(0).cast("long").alias(c) for c in columns]
    return done.unionByName(keyed.filter("key IS NULL").select("doc_id", *zeros, F.lit("").alias("groups_sha256")))


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment measures of every document."""
    return alignment(table(spark, sf_dir, "documents"))
