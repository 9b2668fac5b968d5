"""Exact top-k inner product search by pivot-table elimination.

Vectors become integers, ``floor(1024 * x)``. For a query q and a vector x, the inner product is
``(|q|^2 + |x|^2 - |q - x|^2) / 2``. The table holds the distances of every vector to ``PIVOTS`` pivots; by the triangle
inequality the largest ``|d(q, p) - d(x, p)|`` bounds the distance ``|q - x|`` from below, and so the score from above.
A query evaluates vectors in the order of their bounds and stops at the first one whose bound is below its k-th best
score: the rest cannot enter, ties included. Scores are computed on integers.

Vectors and queries are dealt to blocks by hash of their id, and each pair of a vector block and a query block is a task
of bounded size with its own top k; the lists are merged by a partial limit before the shuffle. Pivots are picked far
apart from a bounded sample (``PIVOT_SAMPLE`` vectors of the lowest hash); they change the work, never the result.

Defined results: a vector that is null, or holds a null or non-finite component, takes no part, and neither does a null
id. Vectors of other lengths than the query are compared as if padded with zeros. Rows with the same id are vectors of
their own, but none is a candidate of a query with its id. Fewer than k other vectors give fewer rows. Components of
2^21 and more in absolute value after scaling are refused, since their sums could not be exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table, written

SCALE = 1024
TOP = 10
PIVOTS = 32
PIVOT_SAMPLE = 1024
VECTOR_BLOCK, QUERY_BLOCK = 8192, 1024
# Vectors evaluated at once for a query.
STEP = 256


def scaled(vector: Column) -> Column:
    """Integer components; null unless all components are there and finite."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    if np.abs(out).max(initial=0) >= 1 << 21:
        raise ValueError("scaled components of 2**21 and more cannot be summed exactly")
    return out


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows far from each other: each next one has the largest distance to those chosen."""
    if not len(sample):
        return sample
    chosen, near = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def search_block(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, pivots: np.ndarray, top: int):
    """(query, row of x, score) of the best ``top`` rows of each query, and how many scores were computed."""
    dq, dx = distances(q, pivots), distances(x, pivots)
    qq, xx = (q**2).sum(1), (x**2).sum(1)
    out, evaluated = [], 0
    for i in range(len(q)):
        # Distances are rounded to about 1e-16 of their size; the slack keeps the bound a bound.
        far = np.abs(dx - dq[i]).max(1) if len(pivots) else np.zeros(len(x))
        far = np.maximum(far - 1e-6 * (1 + far + dq[i].max(initial=0)), 0)
        bound = (qq[i] + xx - far**2) / 2 + 1
        bound[x_id == q_id[i]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        best_row, best = np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(order), STEP):
            rows = order[at : at + STEP]
            if bound[rows[0]] == -np.inf or (len(best) == top and bound[rows[0]] < best[-1]):
                break
            rows = rows[bound[rows] > -np.inf]
            evaluated += len(rows)
            best_row = np.concatenate([best_row, rows])
            best = np.concatenate([best, x[rows] @ q[i]])
            keep = np.lexsort((x_id[best_row], -best))[:top]
            best_row, best = best_row[keep], best[keep]
        out.append((np.full(len(best), i), best_row, best))
    return tuple(np.concatenate(c) for c in zip(*out)) + (evaluated,)


def search(vectors: DataFrame, queries: DataFrame, top: int = TOP, pivots: int = PIVOTS) -> DataFrame:
    """Best ``top`` of ``vectors`` (vec_id, embedding) for each of ``queries``: query_id, rank, vec_id, score."""
    def valid(df: DataFrame) -> DataFrame:
        whole = df.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("vector"))
        return whole.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())

    x, q = written(valid(vectors), "vectors"), written(valid(queries), "queries")
    n, width = x.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    m, wide = q.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    width = max(width, wide)
    sample = x.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(PIVOT_SAMPLE).select("vector").toPandas()["vector"]
    chosen = choose_pivots(_matrix(sample, width), pivots)
    x_blocks, q_blocks = max(1, -(-n // VECTOR_BLOCK)), max(1, -(-m // QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
        return df.select(
            "vec_id", "vector", block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        x_id, q_id = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        query, row, score, _ = search_block(
            _matrix(right["vector"], width), q_id, _matrix(left["vector"], width), x_id, chosen, top
        )
        return pd.DataFrame({"query_id": q_id[query], "vec_id": x_id[row], "score": score.astype(np.int64)})

    keys = ["_x", "_q"]
    found = dealt(on_workers(x), "_x", x_blocks, "_q", q_blocks).groupBy(*keys).cogroup(
        dealt(q, "_q", q_blocks, "_x", x_blocks).groupBy(*keys)
    ).applyInPandas(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score"
    )


def op2_pivot_search(spark, sf_dir: str) -> DataFrame:
    """Ten highest inner products of every hundredth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.vector, x.vector)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
