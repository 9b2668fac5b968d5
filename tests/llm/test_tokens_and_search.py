"""Token counts by section and exact top-k search."""

import random

import numpy as np
import pytest

from palaver.llm import pivot_search as S
from palaver.llm import token_counts as C
from palaver.llm.tokens import encoder
from tests.llm.data import ODD, documents, words


def plain_counts(text):
    """By the offsets of ``tokenizers``, character by character."""
    raw = (text or "").encode()
    ends, seen = [], False
    for i, b in enumerate(raw):
        seen |= b != 10
        if seen and b == 10 and i + 1 < len(raw) and raw[i + 1] != 10:
            ends.append(i + 1)
    ends.append(len(raw))
    owner = [sum(e <= i for e in ends) for i in range(len(raw))]
    counts, at = [0] * len(ends), 0
    for token in encoder().whole().encode(text or "", add_special_tokens=False).ids:
        size = int(encoder().lengths[token])
        inside = [owner[i] for i in range(at, at + size)]
        counts[max(sorted(set(inside)), key=inside.count)] += 1
        at += size
    chars = [len(raw[:e].decode()) for e in ends]
    return list(zip([0, *chars[:-1]], chars, counts))


TEXTS = ["", "a", "\n", "\n\n\n", "one\ntwo", "one\n\n\ntwo\n", "\n\nlead", "é\n你好\n\n \n\nx", "a \n b\n\tc\n\n\n\nd",
         "a\r\n\r\nb", "x  \n  y", "line\n" * 50]


def test_sections_equal_the_plain_count(spark):
    rows = list(enumerate(TEXTS)) + ODD[:-1]
    got = {}
    for r in C.section_counts(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.tokens))
    for doc_id, text in rows:
        mine = sorted(got[doc_id])
        repeat = sum(d == doc_id for d, _ in rows)
        want = [(k, *c) for k, c in enumerate(plain_counts(text)) for _ in range(repeat)]
        assert mine == want, text
    assert C.section_counts(documents(spark, rows).limit(0)).count() == 0


def test_boundary_rule():
    ends = np.array([4, 6, 10])
    assert C.attribute(ends, np.array([3, 7, 10])).tolist() == [0, 1, 2]  # bytes 3..6: one, two and one byte
    assert C.attribute(ends, np.array([2, 6, 10])).tolist() == [0, 0, 2]  # equal shares: the earlier
    assert C.attribute(np.array([4]), np.array([4])).tolist() == [0]


def plain_search(rows, queries, top):
    def whole(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return [int(np.floor(1024 * float(x))) for x in v]

    kept = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = set()
    for q, qv in kept:
        if q in queries:
            found = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in kept if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:top])}
    return out


@pytest.mark.parametrize("block", [16, 8192])
def test_search_equals_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(S, "VECTOR_BLOCK", block)
    monkeypatch.setattr(S, "QUERY_BLOCK", 3)
    monkeypatch.setattr(S, "STEP", 4)
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)]  # ties
    rows += [(400, None), (500, [1.0, None]), (600, [float("nan")] * 6), (700, [float("inf")] + [0.0] * 5), (None, [1.0] * 6),
             (800, []), (900, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    queries = {0, 100, 200, 400, 800, 900}
    got = S.search(frame, frame.filter(frame.vec_id.isin(list(queries))), top=5)
    assert {tuple(r) for r in got.collect()} == plain_search(rows, queries, 5)
    assert S.search(frame.limit(0), frame, top=5).count() == 0
    few = frame.filter("vec_id < 3")
    assert S.search(few, few.filter("vec_id = 0")).count() == 2


def test_bounds_spare_scores():
    rng = np.random.default_rng(1)
    centres = rng.integers(-900, 900, (40, 16))
    x = (np.repeat(centres, 100, 0) + rng.integers(-20, 20, (4000, 16))).astype(float)
    ids = np.arange(4000)
    pivots = S.choose_pivots(x[::8], 32)
    *_, evaluated = S.search_block(x[:20], ids[:20], x, ids, pivots, 10)
    assert evaluated < 0.5 * 20 * 4000


def test_large_components_are_refused():
    with pytest.raises(ValueError):
        S._matrix(__import__("pandas").Series([[1 << 21]]), 1)


def test_token_lengths_cover_the_text():
    rng = random.Random(2)
    text = " ".join(words(rng, 200, "abcé你 \n"))
    assert encoder().lengths[encoder().ids(text)].sum() == len(text.encode())
