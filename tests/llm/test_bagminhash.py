import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver.llm import bagminhash as B
from tests.llm.data import ODD, documents, words


def multiset(text):
    w = text.lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1 if w else 0)))


def similarity(a, b):
    x, y = multiset(a), multiset(b)
    return sum((x & y).values()) / max(sum((x | y).values()), 1)


def plain_classes(texts):
    """Lowest id of the connected component, all pairs compared."""
    label = {d: d for d in texts}
    for a, b in combinations(texts, 2):
        if texts[a] == texts[b] or similarity(texts[a], texts[b]) >= 0.8:
            low, high = sorted((label[a], label[b]))
            label = {d: low if v == high else v for d, v in label.items()}
    return label


def corpus(rng):
    texts, n = {}, 0
    for size in (1, 1, 1, 2, 3, 5, 8, 40):
        base = words(rng, rng.randint(60, 160))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words(rng, 1))
            texts[n] = " ".join(copy)
            n += 1
    chain = words(rng, 200)  # each is near its neighbours only
    for k in range(12):
        texts[n] = " ".join(chain[k * 3 : k * 3 + 120])
        n += 1
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    texts = corpus(random.Random(seed))
    docs = documents(spark, list(texts.items())).repartition(5)
    assert {r.doc_id: r.class_id for r in B.classes(docs).collect()} == plain_classes(texts)


@pytest.mark.parametrize("constant, value", [("TURNS", 1), ("DIFFERENT_BITS", -1)])
def test_pairs_with_a_hub_that_no_turn_compares_are_not_lost(spark, monkeypatch, constant, value):
    """All hubs but the first, or every digest: what the turns leave out is compared exactly, the hub itself too."""
    monkeypatch.setattr(B, constant, value)
    texts = corpus(random.Random(3))
    docs = documents(spark, list(texts.items())).repartition(5)
    assert {r.doc_id: r.class_id for r in B.classes(docs).collect()} == plain_classes(texts)


def test_a_hub_is_compared_with_the_nodes_outside_that_are_not_settled(spark):
    text = " ".join(words(random.Random(7), 100))
    texts = spark.createDataFrame([(n, f"{text} t{n}") for n in range(4)], "node long, text string")
    labels = spark.createDataFrame([(3, 0)], "node long, label long")
    family = spark.createDataFrame([(1, 0, False), (2, 0, True), (3, 0, True)], "node long, hub long, settled boolean")
    assert sorted(B.compared(family.filter("node = 1"), labels.limit(0), texts).collect()) == [(1, 0)]
    assert B.compared(family.filter("node > 1 AND node < 3"), labels.limit(0), texts).isEmpty()
    got = {frozenset(r) for r in B.compared(family, labels, texts).collect()}
    assert got & {frozenset((1, 0)), frozenset((1, 3))} and got & {frozenset((1, 2)), frozenset((2, 3)), frozenset((2, 0))}


def test_odd_rows(spark):
    rows = ODD + [(900_007, "word " * 60_000), (900_008, ""), (900_009, None), (900_010, "ONE!")]
    docs = documents(spark, rows).withColumn("class_id", F.lit("mine")).withColumn("weight", F.lit(1))
    got = sorted(((r.doc_id or 0, r.class_id) for r in B.classes(docs).collect()))
    want = {900_001: 900_001, 900_002: 900_002, 900_003: 900_003, 900_004: 900_004, 900_005: 900_005,
            900_006: 900_006, 900_007: 900_006, 900_008: 900_002, 900_009: 900_009, 900_010: 900_004}
    assert got == sorted([(0, None), (900_005, 900_005), *want.items()])
    stage = B.near_duplicate_stage(spark, docs, "")
    assert stage.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in stage.collect()) == [
        0, 900_001, 900_002, 900_003, 900_004, 900_005, 900_006, 900_009
    ]


def test_empty_table(spark):
    assert B.classes(documents(spark, [(1, "a")]).limit(0)).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(4)
    base = words(rng, 40) * 8  # shingles that repeat
    texts = [" ".join(base), " ".join(base[:250]), " ".join(base[:120] + words(rng, 100))]
    text, shingle, count = B.multisets(pa.array(texts))
    assert count.max() >= 6
    s = B.signatures(text, shingle, count, 3)
    assert np.isfinite(s).all()
    for a, b in combinations(range(3), 2):
        assert (s[a] == s[b]).mean() == pytest.approx(similarity(texts[a], texts[b]), abs=0.1)


def test_signatures_do_not_depend_on_the_batch():
    rng = random.Random(5)
    texts = [" ".join(words(rng, n)) for n in (5, 300, 17, 60)] * 3
    together = B.signatures(*B.multisets(pa.array(texts)), len(texts)).astype(np.float32)
    for i, t in enumerate(texts):
        assert np.array_equal(together[i], B.signatures(*B.multisets(pa.array([t])), 1)[0].astype(np.float32))


def test_components_of_a_long_path(spark):
    edges = spark.range(0, 40).selectExpr("id + 1 AS node", "id AS hub")
    more = spark.createDataFrame([(100, 101), (102, 101)], "node long, hub long")
    got = {r.node: r.label for r in B.components(edges.union(more)).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_rows_without_or_with_shared_ids_are_classed_by_their_text(spark):
    rng = random.Random(6)
    base = {name: words(rng, 80) for name in "abc"}
    near = {name: " ".join(w[:40] + words(rng, 1) + w[41:]) for name, w in base.items()}
    text = {name: " ".join(w) for name, w in base.items()}
    rows = [(None, text["a"])] * 6 + [(None, near["a"])] * 2 + [(None, text["b"]), (None, None), (None, None)]
    rows += [(1, text["b"]), (1, text["c"]), (2, near["b"]), (3, near["c"])]
    docs = documents(spark, rows).repartition(4)
    got = Counter((r.doc_id, r.class_id, r.kept) for r in B.row_classes(docs).collect())
    assert got == Counter({(None, None, False): 7, (None, None, True): 3, (None, 1, False): 1, (1, 1, True): 2,
                           (2, 1, False): 1, (3, 1, False): 1})
    kept = B.near_duplicate_stage(spark, docs, "").collect()
    assert Counter(r.doc_id for r in kept) == Counter({None: 3, 1: 2})
    assert len({r.text for r in kept}) == 4  # one of the near copies of "a", "b", "c", and the null text


def test_a_large_group_is_compared_with_about_one_hub_a_node(spark, monkeypatch):
    """1,500 near copies: classes as by all pairs, and about one comparison with a hub for each node."""
    rng = random.Random(9)
    base, texts = words(rng, 120), {}
    for i in range(1500):
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(120)] = f"w{rng.randrange(10_000)}"
        texts[i] = " ".join(copy)
    seen = []
    plain = B.verified
    monkeypatch.setattr(B, "verified", lambda pairs, t: seen.append(pairs.count()) or plain(pairs, t))
    docs = documents(spark, list(texts.items())).repartition(6)
    got = {r.doc_id: r.class_id for r in B.classes(docs).collect()}
    column = {g: k for k, g in enumerate(sorted({g for t in texts.values() for g in multiset(t)}))}
    held = np.zeros((len(texts), len(column)), np.float32)
    for i, t in texts.items():
        held[i, [column[g] for g in multiset(t)]] = 1
    shared, size = held @ held.T, held.sum(1)
    near = shared >= 0.8 * (size[:, None] + size - shared) - 1e-6
    label = np.arange(len(texts))
    while (lower := np.where(near, label, len(label)).min(1)).tolist() != label.tolist():
        label = lower
    assert got == dict(enumerate(label.tolist()))
    assert sum(seen) <= 2 * len(texts) and max(Counter(got.values()).values()) > 1000
    assert B.near_duplicate_stage(spark, docs, "").count() == len(set(got.values()))


def test_stage_keeps_one_of_equal_rows(spark):
    docs = documents(spark, [(1, "a b c d e f")] * 50 + [(2, "a b c d e f")] * 3 + [(None, "x y z")] * 4 + [(3, None)] * 2)
    docs = docs.withColumn("_key0", F.lit(1)).withColumn("_KEY1", F.lit(2))
    got = B.near_duplicate_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == {1: 1, None: 1, 3: 2}


def test_stage_joins_the_texts_once(spark):
    docs = documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None)])
    stage = B.near_duplicate_stage(spark, docs, "")
    assert stage._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert Counter((r.doc_id, r.text) for r in stage.collect()) == {(1, "a b c d e f"): 1, (3, None): 2}
