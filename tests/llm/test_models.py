"""Toxicity and language identification: held-out accuracy, odd rows, empty tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver.llm import langid, toxicity
from tests.llm.data import ODD, documents, learns, words

BAD = ["vile", "scum", "trash"]


@pytest.fixture(scope="module")
def toxic_corpus():
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        text, bad = words(rng, rng.randint(20, 120)), i % 4 == 0
        for _ in range(3 * bad):
            text[rng.randrange(len(text))] = rng.choice(BAD)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, toxic_corpus):
    rows, labels = toxic_corpus
    docs = documents(spark, rows + ODD).withColumn("score", F.lit("mine")).withColumn("label", F.lit(7))
    marks = spark.createDataFrame(labels + [(None, 1, 1), (900_002, None, None), (3, 0, None)],
                                  "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    assert 0 < len(model.slots) < 5000
    scored = toxicity.score(docs, model)
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "score", "predicted"]
    got = [(r.doc_id, r.score, r.predicted) for r in scored.collect()]
    assert len(got) == len(rows) + len(ODD) and all(0 <= s <= 1 and p == (s >= 0.5) for _, s, p in got)
    held = [(d, p) for d, _, p in got if d is not None and d < 600 and not learns(d)]
    assert sum(p == (d % 4 == 0) for d, p in held) >= 0.97 * len(held)
    by_id = {d: s for d, s, _ in got}
    assert by_id[900_001] == by_id[900_002] == pytest.approx(toxicity._sigmoid(model.intercept))


def test_toxicity_learns_nothing_from_held_out_labels(spark, toxic_corpus):
    rows, labels = toxic_corpus
    docs = documents(spark, rows)
    kept = [x for x in labels if learns(x[0])]
    turned = kept + [(d, q, 1 - t) for d, q, t in labels if not learns(d)]
    schema = "doc_id long, quality int, toxic int"
    a, b = (toxicity.fit(docs, spark.createDataFrame(x, schema)) for x in (kept, turned))
    assert np.array_equal(a.slots, b.slots) and np.allclose(a.weights, b.weights)


def test_toxicity_without_labels(spark, toxic_corpus):
    docs = documents(spark, toxic_corpus[0])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, none)
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_scores_equal_the_plain_sum():
    weights = np.random.default_rng(0).normal(size=1 << toxicity.BITS)
    texts = pa.array(["a b c a b", "", None, "x"])
    text, slot = toxicity.features(texts)
    want = [toxicity._sigmoid(0.3 + sum(weights[s] for s in set(slot[text == i].tolist()))) for i in range(4)]
    assert np.allclose(toxicity.scores(texts, weights, 0.3), want)


ALPHABETS = {"aa": "abcde", "bb": "fghij", "cc": "éèklm"}


def test_language_on_held_out_rows(spark):
    rng = random.Random(2)
    rows = [
        (i, " ".join(words(rng, rng.randint(3, 200), ALPHABETS[name])), name)
        for i, name in ((i, list(ALPHABETS)[i % 3]) for i in range(240))
    ]
    # Languages of held-out rows are wrong on purpose: nothing may be learned from them.
    told = [(d, t, n if learns(d) else "zz") for d, t, n in rows]
    docs = documents(spark, told + [(5000, "abcde abcde", None)] + [(*o, None) for o in ODD])
    net = langid.fit(docs)
    assert net.languages == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in langid.identify(docs.withColumn("Score", F.lit(1)), net).collect()}
    right = [got[d].lang_pred == n for d, _, n in rows if not learns(d)]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {got[d].lang_pred for d in (900_001, 900_002, 900_003)} == {"und"}
    assert got[5000].lang_pred == "aa"


def test_language_without_rows(spark):
    docs = documents(spark, [(1, "abc", None), (2, None, "en")])
    assert langid.fit(docs) is None
    assert {(r.lang_pred, r.score) for r in langid.identify(docs, None).collect()} == {("und", 0.0)}
    assert langid.fit(docs.limit(0)) is None
    assert [r.doc_id for r in langid.language_stage(spark, docs, "").collect()] == [1]


def test_language_stage_keeps_clean_documents(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, 80, ALPHABETS["aa" if i % 2 else "bb"])), "aa" if i % 2 else "bb") for i in range(80)]
    docs = documents(spark, rows + [(*o, None) for o in ODD])
    kept = langid.language_stage(spark, docs, "")
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {r[0] for r in rows} <= ids and not {900_001, 900_002, 900_003} & ids


def test_folded_tables_equal_the_convolution():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (6, langid.WINDOW)).astype(np.uint8)
    net = langid.train(x, np.array([0, 1, 0, 1, 0, 1]), ["a", "b"])
    pooled = []
    for w in langid.WIDTHS:
        e = net.bytes[x]
        z = sum(e[:, k : langid.WINDOW - w + 1 + k] @ net.filters[w][k] for k in range(w))
        pooled.append(z.max(1))
    h = np.maximum(np.concatenate(pooled, 1) + net.bias, 0)
    want = np.log(langid._softmax(h @ net.out + net.out_bias) + 1e-12)
    assert np.allclose(langid.Applied(net).log_probabilities(x), want, atol=1e-4)


def test_windows_cover_every_byte():
    offsets = np.array([0, 0, 3, 3 + 256, 3 + 256 + 700])
    text, start, length = langid.windows(offsets, None)
    for i in range(4):
        seen = set()
        for t, s, n in zip(text, start, length):
            if t == i:
                seen |= set(range(s, s + n))
        assert seen == set(range(offsets[i], offsets[i + 1]))
