import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import decontaminate as D
from tests.llm.data import ODD, documents, words


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    common = words(rng, 60)

    def text(n):
        return [rng.choice(common) if rng.random() < 0.4 else words(rng, 1)[0] for _ in range(n)]

    items = {i: text(rng.randint(14, 60)) for i in range(30)} | {30: text(150), 31: text(4)}
    docs, leaks = {}, set()
    for d in range(300):
        body = text(rng.randint(5, 300))
        if d % 3 == 0:
            i = rng.randrange(31)
            copy = list(items[i])
            if d % 2:  # a paraphrase: some words replaced, some left out
                for _ in range(len(copy) // 10):
                    copy[rng.randrange(len(copy))] = words(rng, 1)[0]
                for _ in range(len(copy) // 20):
                    del copy[rng.randrange(len(copy))]
            at = rng.randint(0, len(body))
            body[at:at] = copy
            leaks.add((d, i))
        docs[d] = body
    return docs, items, leaks


def test_leaks_equal_all_pairs(spark, corpus):
    docs, items, leaks = corpus
    frame = documents(spark, [(d, " ".join(w)) for d, w in docs.items()] + ODD).withColumn("item_id", F.lit("mine"))
    bench = spark.createDataFrame([(i, " ".join(w).capitalize() + ".") for i, w in items.items()] + [(98, None), (99, "")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.leaks(frame, bench).collect()}
    assert got == leaks
    # Against brute force: the best common subsequence of any stretch twice the item's length.
    best = set()
    for d, w in docs.items():
        for i, item in items.items():
            n = len(item)
            if n >= D.SHORTEST and i != 30:
                share = max(lcs(item, w[a : a + 2 * n]) for a in range(0, max(1, len(w) - n), max(1, n // 2)))
                best |= {(d, i)} if share >= D.RATIO_ALONE * n else set()
    assert best <= got


def test_stage_drops_leaking_documents_only(spark, corpus, tmp_path):
    docs, items, leaks = corpus
    spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    frame = documents(spark, [(d, " ".join(w)) for d, w in docs.items()] + ODD)
    kept = D.decontamination_stage(spark, frame, str(tmp_path))
    assert kept.columns == frame.columns
    gone = {d for d, _ in leaks}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(
        [d for d in docs if d not in gone] + [o[0] or 0 for o in ODD]
    )


def test_empty_tables(spark):
    docs, bench = documents(spark, [(1, "a b c")]), spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(docs, bench).count() == 0
    some = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    assert D.leaks(docs.limit(0), some).count() == 0


def test_bit_rows_are_the_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(40):
        n, m = rng.integers(1, 65), rng.integers(1, 90)
        item, region = rng.integers(0, 6, n), rng.integers(0, 7, m)
        masks = np.zeros((1, 8), np.uint64)
        for k, t in enumerate(item):
            masks[0, t] |= np.uint64(1) << np.uint64(k)
        full = np.array([(1 << int(n)) - 1], np.uint64)
        bits = D._match(region[None], np.array([0]), masks, full)
        assert np.bitwise_count(bits)[0] == lcs(item.tolist(), region.tolist())


def test_latent_terms_span_the_leading_singular_vectors(spark):
    rng = random.Random(3)
    topics = [words(rng, 12) for _ in range(3)]
    docs = documents(spark, [(i, " ".join(rng.choice(topics[i % 3]) for _ in range(64))) for i in range(120)])
    seg = next(D.blocks((i, " ".join(t)) for i, t in enumerate(topics)))
    rows = D.term_rows(docs, seg.vocabulary)
    df, total, share = D.passage_frequencies(rows, seg.size)
    assert total == 120 and share == 1
    idf = np.log((1 + total) / (1 + df))
    latent = D.latent_terms(rows, idf, rank=3)
    vectors = np.add.reduceat(latent[seg.terms], seg.first[:-1], axis=0)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    assert np.abs(vectors @ vectors.T - np.eye(3)).max() < 0.3  # three topics, three directions


def test_long_texts_are_whole(spark, monkeypatch):
    rng = random.Random(4)
    item, body = words(rng, 30), words(rng, 20_000)
    for at in (0, 7_920, 7_936, 8_180, 19_970):
        text = body[:at] + item + body[at:]
        bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
        assert [tuple(r)[:2] for r in D.leaks(documents(spark, [(1, " ".join(text))]), bench).collect()] == [(1, 5)]
        if at:
            break


def test_an_item_that_a_third_of_short_rows_hold_is_found(spark):
    rng = random.Random(5)
    item = words(rng, 34)
    texts = {d: words(rng, rng.randint(20, 60)) for d in range(90)}
    for d in range(0, 90, 3):
        texts[d][5:5] = item
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = D.leaks(documents(spark, [(d, " ".join(t)) for d, t in texts.items()]), bench).collect()
    assert {(r.doc_id, r.item_id, r.ratio) for r in got} == {(d, 7, 1.0) for d in range(0, 90, 3)}
    assert min(r.cosine for r in got) > 0


def test_items_of_frequent_words_are_found(spark):
    rng = random.Random(6)
    frequent = words(rng, 40)
    item = [rng.choice(frequent) for _ in range(30)]
    texts = {d: [rng.choice(frequent) for _ in range(60)] for d in range(60)}
    for d in range(5):
        texts[d][20:20] = item
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.ratio for r in D.leaks(documents(spark, [(d, " ".join(t)) for d, t in texts.items()]), bench).collect()}
    assert {d for d, ratio in got.items() if ratio == 1} == set(range(5))


def test_edited_items_are_found_as_by_brute_force(spark):
    rng = random.Random(7)
    vocabulary = words(rng, 400)
    usual = [vocabulary[min(int(rng.paretovariate(0.7)), 400) - 1] for _ in range(20_000)]
    items, docs, planted = {}, {}, set()
    for i in range(40):
        n = rng.randint(15, 64)
        items[i] = [rng.choice(usual) for _ in range(n)]
        for kind in ("replaced", "replaced", "inserted", "inserted"):
            copy = list(items[i])
            if kind == "replaced":  # the last quarter, the answer, stays
                for k in rng.sample(range(n - n // 4), int(n * rng.choice([0.2, 0.3, 0.4]))):
                    copy[k] = words(rng, 1)[0]
            else:
                for _ in range(int(n * rng.choice([0.25, 0.5, 0.75]))):
                    copy.insert(rng.randrange(1, len(copy)), rng.choice(usual))
            planted.add((len(docs), i))
            docs[len(docs)] = [rng.choice(usual) for _ in range(60)] + copy + [rng.choice(usual) for _ in range(60)]
    bench = [(i, " ".join(w[: -(len(w) // 4)]) + ". " + " ".join(w[-(len(w) // 4) :])) for i, w in items.items()]
    found = D.leaks(documents(spark, [(d, " ".join(w)) for d, w in docs.items()]),
                    spark.createDataFrame(bench, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.matched for r in found}
    assert planted <= set(got)
    # The share of all pairs' leaks that the cosine leads to, without the exact source.
    assert len({(r.doc_id, r.item_id) for r in found if r.by_cosine} & planted) >= 0.9 * len(planted)
    for d in range(0, len(docs), 8):
        for i, item in items.items():
            n, w = len(item), docs[d]
            best = max(lcs(item, w[a : a + 2 * n]) for a in range(0, max(1, len(w) - 2 * n + 1), 4))
            assert got.get((d, i), 0) >= best or best < D.RATIO_ALONE * n


def test_all_segments_of_a_long_item_count(spark):
    rng = random.Random(8)
    item = words(rng, 150)
    text = words(rng, 40) + item[:120] + words(rng, 40)  # of the last of three segments 0.4
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    docs = documents(spark, [(1, " ".join(text)), (None, " ".join(text)), (2, " ".join(item[:80]))])
    got = sorted((r.doc_id or 0, r.matched) for r in D.leaks(docs, bench).collect())
    assert got == [(0, 120), (1, 120)]


def test_cosine_thresholds_let_edited_copies_through_and_few_others():
    rng = np.random.default_rng(9)
    seg = D._segments([(i, rng.integers(0, 2**63, 40).astype(np.uint64), 10) for i in range(50)])
    latent = np.linalg.qr(rng.normal(size=(seg.size, 64)))[0].astype(np.float32)
    threshold = D.cosine_thresholds(seg, latent, np.ones(seg.size), 0.5)
    find = D.Search(seg, latent, np.ones(seg.size), threshold)
    held, others = 0, 0
    for s in range(50):
        copy = seg.terms[seg.first[s] : seg.first[s + 1]].copy()
        copy[rng.choice(30, 16, replace=False)] = -1
        text = np.concatenate([np.full(60, -1), copy, np.full(50, -1)])
        text[:30] = rng.integers(0, seg.size, 30)
        pairs = {int(x) for _, segment, _ in find._by_cosine(np.array([0, len(text)]), np.where(text < 0, seg.size, text)) for x in segment}
        held, others = held + (s in pairs), others + len(pairs - {s})
    assert held >= 45 and others < 250


def test_short_items_are_found_as_runs(spark):
    rng = random.Random(10)
    item, body = words(rng, 7), words(rng, 80)
    split = body[:20] + item[:4] + ["between"] + item[4:] + body[20:]
    docs = documents(spark, [(1, " ".join(body[:30] + item + body[30:])), (2, " ".join(split)), (3, " ".join(item)),
                             (4, " ".join(item[:6])), (5, "the end")])
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "the end")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.matched) for r in D.leaks(docs, bench).collect())
    assert got == [(1, 7, 7), (3, 7, 7)]  # two words are too few to search


def test_rows_without_or_with_one_doc_id_count_apart(spark, tmp_path):
    rng = random.Random(11)
    item, body = words(rng, 120), words(rng, 50)
    whole, clean = " ".join(body + item), " ".join(body)
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    halves = [(None, " ".join(item[:60])), (None, " ".join(item[60:]))]
    assert D.leaks(documents(spark, halves), bench).count() == 0
    rows = halves + [(None, whole), (None, clean), (5, whole), (5, clean), (6, whole), (6, whole), (None, None)]
    docs = documents(spark, rows).withColumn("key", F.lit("mine")).withColumn("_key", F.lit(1)).withColumn("terms", F.lit(2))
    found = sorted((r.doc_id or 0) for r in D.leaks(docs, bench).collect())
    assert found == [0, 5, 6]
    kept = D.decontamination_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept.collect())) == sorted(
        [(0, t) for _, t in halves] + [(0, clean), (5, clean), (0, "")]
    )


def test_terms_are_told_apart_by_their_whole_hashes():
    vocabulary = np.array([5, 6, 9, 1 << 60], np.uint64)  # the first three share a slot
    look = D.term_lookup(vocabulary)
    assert look(np.array([6, 7, 9, 1 << 60, (1 << 60) + 1, 5, 2**64 - 1], np.uint64)).tolist() == [1, -1, 2, 3, -1, 0, -1]


def mixed_search(rng, threshold):
    """Segments of all classes, texts around every second one of them, and the search with one threshold."""
    lengths = [9, 11, 14, 20, 23, 25, 36, 47, 50, 64] * 3
    items = [rng.integers(0, 2**63, n).astype(np.uint64) for n in lengths]
    seg = D._segments([(i, item, 5) for i, item in enumerate(items)])
    latent = np.linalg.qr(rng.normal(size=(seg.size, 96)))[0].astype(np.float32)
    frequency, texts = rng.integers(1, 50, seg.size), []
    for s, n in enumerate(lengths):
        copy = seg.terms[seg.first[s] : seg.first[s + 1]].copy()
        copy[rng.choice(n, n // 3, replace=False)] = seg.size
        texts += [copy, np.where(rng.random(300) < 0.5, rng.integers(0, seg.size, 300), seg.size)]
        if s % 2:
            texts[-1][100 : 100 + n] = copy
    texts.append(np.array([seg.size]))
    find = D.Search(seg, latent, frequency, np.full(len(lengths), threshold, np.float32))
    return find, texts, np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def test_windows_are_those_of_plain_cosines(monkeypatch):
    find, texts, offsets = mixed_search(np.random.default_rng(12), 0.45)
    want, near = set(), set()  # pairs of row and segment; those too close to the threshold to tell
    for windows in find.classes:
        for row, text in enumerate(texts):
            n = -(-len(text) // windows.step)
            for k in windows.blocks:
                for i in range(max(n - k, 0) + 1):
                    x = find.latent[text[i * windows.step : (i + k) * windows.step]].sum(axis=0, dtype=np.float64)
                    cosine = find.vectors[windows.segments] @ x / max(np.linalg.norm(x), 1e-6)
                    want |= {(row, int(s)) for s in windows.segments[cosine >= 0.45 + 1e-5]}
                    near |= {(row, int(s)) for s in windows.segments[abs(cosine - 0.45) < 1e-5]}
    assert len({s for _, s in want}) == 30
    for most in (1, 700, 1 << 20):
        monkeypatch.setattr(D, "SEARCH_WORDS", most)
        got = set()
        for row, segment, begin in find._by_cosine(offsets, np.concatenate(texts)):
            assert ((begin >= offsets[row]) & (begin < offsets[row + 1])).all()
            got |= set(zip(row.tolist(), segment.tolist()))
        assert want <= got <= want | near


def test_regions_of_the_cosine_without_anchors_are_not_compared(monkeypatch):
    find, texts, offsets = mixed_search(np.random.default_rng(13), D.LOWEST)
    terms, plain, compared = np.concatenate(texts), find._verified, []
    regions = np.concatenate([np.stack(x) for x in find._by_cosine(offsets, terms)], axis=1)
    kept = plain(*regions, np.ones(regions.shape[1], bool), offsets, terms, find.need)

    def counted(row, segment, begin, by_cosine, *rest):
        compared.append(by_cosine.sum())
        return plain(row, segment, begin, by_cosine, *rest)

    monkeypatch.setattr(find, "_verified", counted)
    row, segment, *_, by_cosine = find(offsets, terms)
    # The same pairs as where every region is compared, from a small part of the regions.
    assert set(zip(row[by_cosine], segment[by_cosine])) == set(zip(*kept[:2])) != set()
    assert sum(compared) < 0.5 * regions.shape[1]


def test_terms_of_large_vocabularies_are_whole(spark):
    texts = [(1, "alpha beta gamma"), (2, ""), (3, "beta " * 9000), (None, "delta")]
    hashes = D.words_of(D.pa.array(["alpha beta gamma"])).hashes
    for size in (1 << 15, (1 << 15) + 1):
        fill = np.random.default_rng(14).integers(0, 2**63, size - 3).astype(np.uint64)
        vocabulary = np.unique(np.concatenate([hashes, fill]))
        want = np.searchsorted(vocabulary, hashes).tolist()
        batches = D.term_rows(documents(spark, texts), vocabulary).toArrow().to_batches()
        got = [
            (part.column("doc_id")[i].as_py(), terms[a:b].tolist())
            for part, offsets, terms in D._chunks((b.slice(k) for b in batches for k in range(min(2, b.num_rows))), len(vocabulary))
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:]))
        ]
        assert (1, want) in got and (None, [-1]) in got
        assert {len(t) for d, t in got if d == 3} == {D.PIECE, 9000 - D.PIECE + D.OVERLAP}
        assert all(set(t) == {want[1]} for d, t in got if d == 3)
