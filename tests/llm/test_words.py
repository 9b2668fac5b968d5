import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from palaver.llm import words as W

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab cZé.\n", max_size=40)), max_size=8)


def plain(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_words_are_runs_of_letters_and_digits(texts):
    got = W.words_of(pa.array(texts, pa.string()))
    assert got.counts.tolist() == [len(plain(t)) for t in texts]
    seen = {}
    for word, value in zip([w for t in texts for w in plain(t)], got.hashes.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_shingles_stay_inside_a_text(texts):
    values, first = W.shingles(W.words_of(pa.array(texts, pa.string())), 3)
    seen = {}
    for i, text in enumerate(texts):
        w = plain(text)
        runs = [tuple(w[k : k + 3]) for k in range(max(len(w) - 2, 1 if w else 0))]
        assert first[i + 1] - first[i] == len(runs)
        for run, value in zip(runs, values[first[i] : first[i + 1]].tolist()):
            assert seen.setdefault(run, value) == value
    assert len(set(seen.values())) == len(seen)


def test_long_buffers_hash_like_short_ones(monkeypatch):
    texts = pa.array(["alpha beta gamma " * 50, "beta", None, "x" * 3000 + " alpha"])
    want = W.words_of(texts)
    monkeypatch.setattr(W, "CHUNK_BYTES", 64)
    assert np.array_equal(want.hashes, W.words_of(texts).hashes)


def test_slices_hold_all_rows():
    batch = pa.record_batch({"text": ["a" * 10, None, "b" * 50, "", "c"], "n": [1, 2, 3, 4, 5]})
    parts = list(W.sliced([batch], "text", most=12, rows=2))
    assert [n for p in parts for n in p.column("n").to_pylist()] == [1, 2, 3, 4, 5]
    assert all(p.num_rows <= 2 for p in parts)
