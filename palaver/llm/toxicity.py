"""Toxicity: FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Features of a text are the distinct hashes of its words, of its neighbouring word pairs and of its pairs with one word
between, in ``2**BITS`` slots. Each slot has its own learning rate, and the L1 term keeps slots without evidence at
exactly zero, so the fitted model is a short list of (slot, weight). One task learns it from a bounded sample of labelled
rows; scoring is one pass over all texts, each read whole, without a shuffle.

Defined results: a null or empty text has no features and scores as the intercept does. Without a labelled row of either
class there is nothing to learn, and every text scores 0. Several labels for one key count as toxic if one of them is;
a null label or key teaches nothing. Columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import held_out, may_learn, on_workers, table, without
from palaver.llm.words import grams, sliced, words_of

BITS = 20
# At most this many labelled texts are learned from, those of the lowest key hash.
TRAINING_ROWS = 16_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 6.0, 0.0


@dataclass(frozen=True)
class Model:
    slots: np.ndarray
    weights: np.ndarray
    intercept: float


NOTHING_LEARNED = Model(np.zeros(0, np.int32), np.zeros(0), -np.inf)


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of every word, word pair and skip-gram, with repeats."""
    words = words_of(texts)
    kinds = [(words.hashes, words.text_of), grams(words, 1, 2), grams(words, 2, 3)]
    slot = np.concatenate([k[0] for k in kinds]) >> np.uint64(64 - bits)
    return np.concatenate([k[1] for k in kinds]), slot.astype(np.int64)


def _distinct(text: np.ndarray, slot: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(text << bits | slot)
    return both >> bits, both & ((1 << bits) - 1)


class Ftrl:
    """Per-coordinate FTRL-proximal state; ``z`` is the shifted gradient sum, ``n`` the sum of squared gradients."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)  # the last slot is the intercept

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / rate, 0.0)

    def intercept(self) -> float:
        return -self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / ALPHA)

    def learn(self, slots: np.ndarray, label: int) -> None:
        w, b = self.weights(slots), self.intercept()
        g = _sigmoid(b + w.sum()) - label
        at, w = np.append(slots, len(self.z) - 1), np.append(w, b)
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def _sigmoid(x):
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-np.asarray(x, np.float64)))


def calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid over the margins of the learned rows (Platt's targets, a few Newton steps)."""
    x, line = np.stack([margin, np.ones_like(margin)], 1), np.array([1.0, 0.0])
    ones, zeros = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    for _ in range(25):
        p = _sigmoid(x @ line)
        slope = x.T @ (p - target) + 1e-3 * (line - [1.0, 0.0])
        line = line - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), slope)
    return float(max(line[0], 1e-3)), float(line[1])


def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From all (text, label) of the sample, in the order given, to the weights that are not zero; slot -1: intercept."""
    rows: list[np.ndarray] = []
    labels: list[int] = []
    for batch in sliced(batches, "text"):
        text, slot = _distinct(*features(batch.column("text")), BITS)
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        rows += [slot[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]
        labels += batch.column("label").to_pylist()
    label = np.array(labels, dtype=np.int64)
    if not 0 < label.sum() < len(label):
        return
    state = Ftrl()
    for _ in range(EPOCHS):
        for slots, y in zip(rows, labels):
            state.learn(slots, y)
    weights = state.weights(slice(0, -1))
    slope, shift = calibrate(np.array([weights[s].sum() for s in rows]) + state.intercept(), label)
    at = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(at, -1), pa.int32()),
            pa.array(np.append(weights[at] * slope, state.intercept() * slope + shift), pa.float64()),
        ],
        names=["slot", "weight"],
    )


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Learn from at most ``rows`` of the texts in ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks.

    Every fifth key, by its checksum, is left out. Only keys go through the choice of the sample; the texts of the chosen
    keys are then fetched by a join with at most ``rows`` keys and sorted in the one task that learns.
    """
    marked = labels.filter(may_learn() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("label")
    )
    present = docs.select("doc_id").filter(may_learn()).distinct()
    order = F.xxhash64("doc_id")
    chosen = marked.join(present, "doc_id", "left_semi").orderBy(order, "doc_id").limit(rows)
    # At most ``rows`` keys with their labels are broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    fitted = (
        on_workers(sample).repartition(1).sortWithinPartitions(order, "doc_id").select("text", "label")
        .mapInArrow(train, "slot int, weight double").toArrow()
    )
    slots, weights = fitted["slot"].to_numpy(), fitted["weight"].to_numpy()
    if not len(slots):
        return NOTHING_LEARNED
    return Model(slots[slots >= 0].astype(np.int32), weights[slots >= 0], float(weights[slots < 0][0]))


def scores(texts: pa.Array, dense: np.ndarray, intercept: float) -> np.ndarray:
    text, slot = features(texts)
    hit = dense[slot] != 0
    text, slot = _distinct(text[hit], slot[hit], BITS)
    return _sigmoid(intercept + np.bincount(text, dense[slot], minlength=len(texts)))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    source = without(docs, ["score", "predicted"])
    kept = [c for c in (keep or source.columns) if c.lower() not in ("score", "predicted")]
    source = source.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, "text"])])
    schema = T.StructType([*source.select(*[f"`{c}`" for c in kept]).schema, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS, np.float64)
        dense[model.slots] = model.weights
        for batch in sliced(batches, "text"):
            out = pa.array(scores(batch.column("text"), dense, model.intercept))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], out], names=[*kept, "score"])

    return on_workers(source).mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every document: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).filter("predicted = 0").select(*docs.columns)
