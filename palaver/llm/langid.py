"""Language identification: a small convolutional network over bytes, trained in numpy.

A text is cut into windows of 256 bytes; the last one ends with the text, and a shorter text is padded with zero bytes.
Byte embeddings go through filters of two, three and four bytes; the highest answer of each filter in a window feeds a
softmax over the learned languages. A text's probabilities are the normalised mean of its windows' log-probabilities,
weighted by length, so every byte of every text counts. For application, each filter is folded into tables over byte
pairs, and windows go through in batches of fixed size, however long a text is.

Learning takes a bounded sample: at most ``DOCS_PER_LANGUAGE`` texts of each language (lowest key hash), ``DOCS`` in all,
and ``WINDOWS_PER_DOC`` windows of each, spread over the whole text.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text when no row could be
learned from. Columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import held_out, may_learn, on_workers, table, without
from palaver.llm.words import plain_array, sliced, string_buffers

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
DOCS_PER_LANGUAGE = 600
# At most this many texts are learned from in all; the first of every language come before the second of any.
DOCS = 60_000
WINDOWS_PER_DOC = 4
EPOCHS = 8
BATCH = 64
# Windows convolved at once.
TOGETHER = 512
UNKNOWN = "und"
# The pipeline keeps a document from this probability of its likeliest language on.
DECIDED = 0.4


@dataclass
class Network:
    """Weights; ``filters[w]`` has the shape (w, EMBEDDING, FILTERS)."""

    languages: list[str]
    bytes: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def windows(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first byte and length of every window."""
    sizes = np.diff(offsets)
    n = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    length = np.minimum(sizes, WINDOW)[text]
    return text, offsets[text] + np.minimum(nth * WINDOW, sizes[text] - length), length


def window_bytes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = np.arange(WINDOW)
    inside = at < length[:, None]
    return np.where(inside, data[np.where(inside, start[:, None] + at, 0)], 0).astype(np.uint8)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on the cross-entropy. The gradient of a maximum reaches only the bytes where it was taken."""
    rng = np.random.default_rng(seed)
    p = {
        "bytes": rng.normal(0, 0.5, (256, EMBEDDING)), "bias": np.zeros(FILTERS * len(WIDTHS)),
        "out": rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))), "out_bias": np.zeros(len(languages)),
        **{w: rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)) for w in WIDTHS},
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            xb, yb = x[order[at : at + BATCH]].copy(), y[order[at : at + BATCH]]
            cut = np.where(rng.random(len(xb)) < 0.4, rng.integers(12, WINDOW, len(xb)), WINDOW)
            xb[np.arange(WINDOW) >= cut[:, None]] = 0  # so that short texts are seen too
            e = p["bytes"][xb]
            pooled, where = [], []
            for w in WIDTHS:
                view = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2)
                z = view.reshape(len(xb), WINDOW - w + 1, w * EMBEDDING) @ p[w]
                where.append(z.argmax(1))
                pooled.append(np.take_along_axis(z, where[-1][:, None], 1)[:, 0])
            h = np.concatenate(pooled, 1) + p["bias"]
            r = np.maximum(h, 0)
            d = _softmax(r @ p["out"] + p["out_bias"])
            d[np.arange(len(yb)), yb] -= 1
            d /= len(yb)
            g = {"out": r.T @ d, "out_bias": d.sum(0), "bytes": np.zeros_like(p["bytes"])}
            dh = (d @ p["out"].T) * (h > 0)
            g["bias"] = dh.sum(0)
            for k, w in enumerate(WIDTHS):
                dz = dh[:, k * FILTERS : (k + 1) * FILTERS]
                seen = xb[np.arange(len(xb))[:, None, None], where[k][..., None] + np.arange(w)]  # row, filter, byte
                patch = p["bytes"][seen].reshape(len(xb), FILTERS, w * EMBEDDING)
                g[w] = np.einsum("bf,bfi->if", dz, patch)
                back = (dz[..., None] * p[w].T).reshape(-1, EMBEDDING)
                np.add.at(g["bytes"], seen.reshape(-1), back)
            step += 1
            for k in p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] ** 2 - v[k])
                p[k] -= 4e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Network(
        languages, p["bytes"], {w: p[w].reshape(w, EMBEDDING, FILTERS) for w in WIDTHS}, p["bias"], p["out"],
        p["out_bias"],
    )


class Applied:
    """The network with its filters folded into tables over bytes and byte pairs."""

    def __init__(self, net: Network):
        self.net = net
        one = {w: [net.bytes @ net.filters[w][k] for k in range(w)] for w in WIDTHS}

        def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.ascontiguousarray((a[:, None] + b[None]).reshape(1 << 16, FILTERS))

        # For each width, (offset of the bytes, table, whether it is over pairs).
        self.tables = {
            w: [
                (k, pair(one[w][k], one[w][k + 1]), True) if k + 1 < w else (k, one[w][k], False)
                for k in range(0, w, 2)
            ]
            for w in WIDTHS
        }

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        pooled = []
        for w in WIDTHS:
            n = WINDOW - w + 1
            total = None
            for k, values, over_pairs in self.tables[w]:
                part = np.take(values, (pairs if over_pairs else x)[:, k : k + n], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(total.max(1))
        h = np.maximum(np.concatenate(pooled, 1) + self.net.bias, 0)
        return np.log(_softmax(h @ self.net.out + self.net.out_bias) + 1e-12)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index of the likeliest language and its probability, for each text."""
        offsets, data = string_buffers(plain_array(texts))
        text, start, length = windows(offsets, data)
        total = np.zeros((len(texts), len(self.net.languages)))
        for at in range(0, len(text), TOGETHER):
            part = slice(at, at + TOGETHER)
            logs = self.log_probabilities(window_bytes(data, start[part], length[part]))
            np.add.at(total, text[part], logs * length[part][:, None])
        weight = np.bincount(text, length, minlength=len(texts))
        p = _softmax(total / np.maximum(weight, 1)[:, None])
        return p.argmax(1), p.max(1)


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, most: int = DOCS) -> Network | None:
    """Learn from ``docs`` (doc_id, text, lang), but for every fifth key; None when nothing can be learned.

    Keys and languages alone go through the choice of the sample; at most ``most`` of them are broadcast to fetch the
    texts. The driver gets at most ``WINDOWS_PER_DOC`` windows of 256 bytes for each.
    """
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        docs.select("doc_id", "lang").filter(may_learn() & F.col("lang").isNotNull()).distinct()
        .withColumn("_nth", F.row_number().over(by_hash)).filter(F.col("_nth") <= per_language)
    )
    keys = chosen.orderBy("_nth", "lang").limit(most).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    sample = docs.select("doc_id", "text").join(F.broadcast(keys), "doc_id")
    sample = sample.dropDuplicates(["doc_id"]).filter(F.col("text").rlike(r"\p{L}"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            offsets, data = string_buffers(plain_array(batch.column("text")))
            text, start, length = windows(offsets, data)
            n = np.bincount(text, minlength=batch.num_rows)
            nth = np.arange(len(text)) - (np.cumsum(n) - n)[text]
            take = np.flatnonzero((nth * WINDOWS_PER_DOC) // n[text] != ((nth - 1) * WINDOWS_PER_DOC) // n[text])
            made = window_bytes(data, start[take], length[take])
            rows = pa.array([bytes(r) for r in made], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(text[take]), pa.array(nth[take], pa.int64()),
                 batch.column("lang").take(text[take]), rows],
                names=["doc_id", "nth", "lang", "bytes"],
            )

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("nth", T.LongType()),
        T.StructField("lang", T.StringType()), T.StructField("bytes", T.BinaryType()),
    ])
    got = on_workers(sample).select("doc_id", "text", "lang").mapInArrow(cut, schema).toArrow().sort_by(
        [("doc_id", "ascending"), ("nth", "ascending")]
    )
    if not got.num_rows:
        return None
    languages = sorted(set(got["lang"].to_pylist()))
    x = np.frombuffer(b"".join(got["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    y = np.array([languages.index(v) for v in got["lang"].to_pylist()])
    return train(x, y, languages)


def identify(docs: DataFrame, net: Network | None, keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``lang_pred`` and ``score``."""
    source = without(docs, ["lang_pred", "score"])
    kept = [c for c in (keep or source.columns) if c.lower() not in ("lang_pred", "score")]
    source = source.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, "text"])])
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return source.select(*[f"`{c}`" for c in kept], F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    source = source.withColumn("_letter", letter)
    fields = [*source.select(*[f"`{c}`" for c in kept]).schema]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        applied, names = Applied(net), np.array([*net.languages, UNKNOWN], dtype=object)
        for batch in sliced(batches, "text"):
            best, p = applied(batch.column("text"))
            letters = batch.column("_letter").to_numpy(zero_copy_only=False).astype(bool)
            pred = pa.array(names[np.where(letters, best, len(net.languages))], pa.string())
            out = pa.array(np.where(letters, p, 0.0), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pred, out], names=[*kept, "lang_pred", "score"]
            )

    return on_workers(source).mapInArrow(run, schema)


def op8_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, fit(docs), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a learned language; those without a letter, and those no language is likely for, go.

    Where no row could be learned from, only those without a letter go.
    """
    net = fit(docs)
    if net is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, net).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= DECIDED))
    return found.select(*docs.columns)
