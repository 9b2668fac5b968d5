"""Context-tree weighting against a plain tree."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver.llm.context_tree import (
    _whole_groups, batch_cells, batch_words, cell_counts, cells_of, code_lengths, log_gamma, node_levels, op12_lm_scores, scores,
)
from palaver.llm.frequent import frequent
from tests.llm.data import ODD, documents, words


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def coded(text):
    return b"".join(w + b" " for w in plain_words(text)) + b" "


class Tree:
    """Nodes in dictionaries, weighted probabilities by recursion."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.longer = depth, {}, {}
        for text in texts:
            s = b" " * depth + coded(text)
            for i in range(depth, len(s)):
                for d in range(depth + 1):
                    context = s[i - d : i]
                    for level in range(8):
                        key = context, (256 | s[i]) >> (8 - level)
                        self.counts.setdefault(key, [0, 0])[s[i] >> (7 - level) & 1] += 1
                        if d < depth:
                            self.longer.setdefault(key, set()).add((s[i - d - 1 : i], key[1]))
        self.memo = {}

    def log_e(self, key):
        a, b = self.counts[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def log_w(self, key):
        if key not in self.memo:
            own = self.log_e(key)
            if len(key[0]) < self.depth:
                other = sum(self.log_w(k) for k in self.longer[key])
                high = max(own, other)
                own = high + math.log((math.exp(own - high) + math.exp(other - high)) / 2)
            self.memo[key] = own
        return self.memo[key]

    def one(self, context, prefix, d=0):
        """Probability of a one bit, by the recursion from short to long contexts."""
        key = context[len(context) - d :], prefix
        if key not in self.counts:
            return None
        a, b = self.counts[key]
        own = (b + 0.5) / (a + b + 1)
        deeper = self.one(context, prefix, d + 1) if d < self.depth else None
        if deeper is None:
            return own
        stop = math.exp(self.log_e(key) - math.log(2) - self.log_w(key))
        return stop * own + (1 - stop) * deeper

    def score(self, text):
        s, total = b" " * self.depth + coded(text), 0.0
        for i in range(self.depth, len(s)):
            for level in range(8):
                one = self.one(s[i - self.depth : i], (256 | s[i]) >> (8 - level))
                one = 0.5 if one is None else one
                total += math.log10(one if s[i] >> (7 - level) & 1 else 1 - one)
        return total


def plain(docs, depth):
    train = [t for i, t in docs if not held(i)]
    tree = Tree(train, depth)
    counts = Counter(w for t in train for w in [*plain_words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in docs:
        tokens = [*plain_words(text), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((doc_id, held(doc_id), len(tokens), sum(w in counts for w in tokens), n, base, tree.score(text)))
    return sorted(out, key=str)


def same(df, expected):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted(map(tuple, df.select(*columns).collect()), key=str)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-9), g[0]


def corpus(n=60):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randint(1, 12), "abcé"))) for i in range(n)]
    odd = [(i, t if t is None or len(t) < 100 else t[:300]) for i, t in ODD]
    return rows + [(1000 + i, "The same\ttext, Twice  over") for i in range(n // 2)] + odd


@pytest.mark.parametrize("depth, most", [(2, 0), (3, 40), (4, 1 << 18)])
def test_equals_plain_tree(spark, depth, most):
    docs = corpus()
    frame = documents(spark, docs).withColumn("cell", F.lit(1)).withColumn("held_out", F.lit("x")).repartition(3)
    same(scores(frame, depth, most, most // 4), plain(docs, depth))


@pytest.mark.parametrize("docs", [[], [(0, None)], [(i, "only held out") for i in range(60) if held(i)]])
def test_little_or_nothing_learned(spark, docs):
    same(scores(documents(spark, docs), depth=2), plain(docs, 2))


def test_probabilities_add_up(spark):
    """Over all 256 bytes in contexts seen often, once and never."""
    texts = [("the cat and the hat",), ("that bat",)]
    seen = cell_counts(spark.createDataFrame(texts, "text string").withColumn("held_out", F.lit(False)), 2)
    contexts = [int.from_bytes(c[::-1], "big") for c in (b"th", b"ha", b"zz", b"qt")]
    every = spark.createDataFrame([(c << 8 | x, 0, 0) for c in contexts for x in range(256)], "cell long, n long, total long")
    asked = seen.unionByName(every).groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).cache()
    out = code_lengths(asked, 2).groupBy((F.shiftright("cell", 8)).alias("c")).agg(F.sum(F.expr("power(10, log10)")).alias("p"))
    got = {r.c: r.p for r in out.collect()}
    assert [got[c] for c in contexts] == pytest.approx([1] * 4, abs=1e-9)


def test_counts_follow_the_corpus(spark):
    one = spark.createDataFrame([("abc",)], "text string").withColumn("held_out", F.lit(False))
    root = node_levels(cell_counts(one.union(one), 2), 2)[0].filter("prefix = 1").first()
    assert root.a + root.b == 2 * len(b"abc  ")


def test_blocks_go_on(monkeypatch):
    text = "One two  three\n\tfour 5 " * 9
    whole = next(cells_of(text)).tolist()
    monkeypatch.setattr("palaver.llm.context_tree._WORDS_IN_BLOCK", 4)
    parts = list(cells_of(text))
    assert len(parts) > 5 and [c for p in parts for c in p.tolist()] == whole


@pytest.mark.parametrize("long", [0, 1 << 20])
def test_batches_equal_single_texts(monkeypatch, long):
    monkeypatch.setattr("palaver.llm.context_tree.LONG", long)
    texts = ["a B", None, "", " ", "two  words\n", "\tlead", "x", "É ü\x0b z ", " \r\n ", "end"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    cells, text = (np.concatenate(c) for c in zip(*batch_cells(batch, 3)))
    words = [(t, w) for block, text_of in batch_words(batch) for t, w in zip(text_of.tolist(), block)]
    for i, t in enumerate(texts):
        assert cells[text == i].tolist() == np.concatenate(list(cells_of(t, 3))).tolist()
        assert [w for k, w in words if k == i] == plain_words(t)


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 3.0, 20.5, 1e6 + 0.5, 1e12]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(log_gamma(F.col("x"), F.log)).collect()
    assert [r[0] for r in got] == pytest.approx([math.lgamma(v) for v in values], rel=1e-12, abs=1e-10)
    assert log_gamma(np.array(values), np.log) == pytest.approx([math.lgamma(v) for v in values], rel=1e-12, abs=1e-10)


def test_groups_are_cut_whole():
    base = np.sort(np.random.default_rng(1).integers(0, 40, 900_000))
    rows = pa.RecordBatch.from_arrays([pa.array(base)], names=["base"])
    parts = list(_whole_groups(rows.slice(i, 10_000) for i in range(0, len(base), 10_000)))
    assert len(parts) > 2 and np.concatenate([p.column("base").to_numpy() for p in parts]).tolist() == base.tolist()
    ends = [(p.column("base")[0].as_py(), p.column("base")[-1].as_py()) for p in parts]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_frequent_is_bounded(spark):
    counted = spark.createDataFrame([(i, 1 + 1000 // (i + 1)) for i in range(500)] + [(999, 0)], "k long, n long")
    for most in (0, 1, 10, 100, 10_000):
        top = [r.n for r in frequent(counted, "n", most).collect()]
        rest = sorted((r.n for r in counted.collect()), reverse=True)[len(top) :]
        assert len(top) <= most and (not top or min(top) >= max(rest))
    assert frequent(counted, "n", 10_000).count() == 500


def test_query_beats_single_words(spark):
    """Over all held-out texts of tables large enough for six bytes of context."""
    out = op12_lm_scores(spark, "/root/testdata/sf0.1").filter("held_out").agg(
        F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.avg("bits_per_byte").alias("bits")
    ).first()
    assert out.score > out.base and 0 < out.bits < 4
