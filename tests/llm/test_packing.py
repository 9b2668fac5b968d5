import random
import zlib

import numpy as np
import pytest

from palaver.llm import packing as P
from palaver.llm.tokens import encoder
from tests.llm.data import ODD, documents, words


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "", "Hello, world!", "a\n\n\nb  c \t d", "café naïve 你好 \U0001f600 ١٢", "it's we'll I'VE x'd",
    "x" * 3000, " " * 500 + "end", "\r\n\r\n", "1234567890 3.14 a1b2", "  wide​blank", "\x00\x01",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_those_of_tokenizers(whole, text):
    assert encoder().ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_names_of_special_tokens_are_text():
    assert 50256 not in encoder().ids("a <|endoftext|> b").tolist()


def check_layout(rows, limit):
    """Every sequence is filled from 0 without gaps and within the limit."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= limit
    return len(by_sequence)


def test_pieces_hold_every_id(spark, whole):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, n))) for i, n in enumerate([3, 900, 2500, 40, 40] + [rng.randint(1, 700) for _ in range(60)])]
    docs = documents(spark, rows + ODD).repartition(4)
    got = P.packing_stage(spark, docs, "").collect()
    sequences = check_layout(got, 2048)
    assert sequences <= 1.05 * sum(r.length for r in got) / 2048 + 1
    for doc_id, text in rows + [o for o in ODD if o[0] not in (None, 900_005)]:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == doc_id)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert all(m[2] == 2048 for m in mine[1:]) and mine[0][1] == 0
        assert sum(m[2] for m in mine) == len(ids)
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for _, s, n, c in mine)
    assert sum(r.doc_id == 900_005 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1


def test_every_capacity_holds():
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 60, 400))[::-1]
    capacity = P.Capacity(tokens=100, documents=4, attention=4000)
    sequence, offset = P.best_fit(lengths, capacity)
    for s in set(sequence.tolist()):
        mine = lengths[sequence == s]
        assert mine.sum() <= 100 and len(mine) <= 4 and (mine**2).sum() <= 4000
        assert sorted(offset[sequence == s].tolist()) == [0, *np.cumsum(mine[np.argsort(offset[sequence == s])])[:-1]]


def test_best_fit_against_the_fewest_sequences():
    lengths = np.array([6, 6, 5, 5, 5, 4, 4, 3, 2, 2, 2, 1])  # 45 tokens: five sequences of ten at best
    sequence, _ = P.best_fit(lengths, P.Capacity(tokens=10, documents=10, attention=100))
    assert len(set(sequence.tolist())) == 5


def test_empty_table(spark):
    assert P.packing_stage(spark, documents(spark, [(1, "a")]).limit(0), "").count() == 0


def test_ids_can_be_kept(spark):
    row = P.pieces(documents(spark, [(1, "Hello")]), with_ids=True).first()
    assert row.ids == [*encoder().ids("Hello").tolist(), 0]
