"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm.resampling import bucket_counts, buckets_of, op11_resampling, ranked, resample, segment_of, word_blocks
from tests.llm.data import ODD, documents, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(low)
    return found, [" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)]


def plain(docs, target, percent=5):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    def counts(texts):
        out = [0] * 10_000
        for text in texts:
            for f in plain_features(text)[1]:
                out[zlib.crc32(f.encode()) % 10_000] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (S + 10_000) / ((a + 1) * (T + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        found, features = plain_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in features)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(found), doc_id, len(features), weight, score))
    order = sorted((r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    drawn = percent * len(order) // 100
    ranks = [(*r[1:], i + 1 if i < drawn else None) for i, r in enumerate(order)]
    return sorted(ranks + [(*r[1:], None) for r in rows if r[0] < 20], key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def corpus(n=400):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, rng.choice([5, 25, 60]), "abcdeé"))) for i in range(n)]
    hot = "Ein Satz, der SEHR oft vorkommt. " * 5
    return rows + [(10_000 + i, hot) for i in range(n // 2)] + [(7_777, hot)] * (n // 2) + ODD


def test_equals_plain_version(spark):
    target = [" ".join(words(random.Random(k), 30, "abé")) for k in range(20)] + [None, ""]
    docs = corpus()
    frame = documents(spark, docs).withColumn("score", F.lit("taken")).withColumn("_low", F.lit(1)).repartition(7)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert result(resample(frame, bench, segment_rows=20, samples=64)) == plain(docs, target)
    assert result(resample(frame, bench, percent=50)) == plain(docs, target, 50)


@pytest.mark.parametrize("name", ["no documents", "no target"])
def test_empty_tables(spark, name):
    docs = [] if name == "no documents" else [(1, "a " * 30), (2, "b"), (3, None)]
    bench = spark.createDataFrame([], "item_id long, text string")
    assert result(resample(documents(spark, docs), bench)) == plain(docs, [])


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_long_texts_come_in_blocks(monkeypatch, most):
    text = "One two  three-four 5 é six " * 40
    monkeypatch.setattr("palaver.llm.resampling.TOGETHER", most)
    blocks = list(word_blocks(text))
    got = sorted(np.concatenate([buckets_of(w, seen) for w, seen in blocks]).tolist())
    assert got == sorted(zlib.crc32(f.encode()) % 10_000 for f in plain_features(text)[1])


@pytest.mark.parametrize("shape", ["random", "sorted", "one value"])
def test_ranks(spark, shape):
    rng = random.Random(2)
    values = {"random": [rng.randint(-50, 50) for _ in range(5000)], "sorted": range(5000), "one value": [3] * 5000}[shape]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a long, b long").repartitionByRange(9, "b")
    out = ranked(rows, ["a", "b"], 1234, segment_rows=300, samples=200).collect()
    got = {(r.a, r.b): r["rank"] for r in out}
    for i, key in enumerate(sorted((v, i) for i, v in enumerate(values))):
        assert got[key] == (i + 1 if i < 1234 else None)
    assert len(out) == 5000


def test_segments_split_ties():
    splitters = [(1, 5, 0), (1, 5, 9), (4, 0, 0)]
    keys = [np.array(k, np.int64) for k in ([1, 1, 1, 0, 4, 9], [5, 5, 5, 9, 1, 0], [0, 4, 10, 0, 0, 0])]
    assert segment_of(keys, splitters).tolist() == [0, 1, 2, 0, 3, 3]


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    out = op11_resampling(spark, sf_dir)
    assert result(out) == plain(docs, target)
    assert dict(out.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert bucket_counts(spark.createDataFrame([(None,), ("a b",)], "text string")).sum() == 3
