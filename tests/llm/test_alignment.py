"""Tokenizer alignment against a plain version."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from palaver.llm.alignment import align, alignment, aligned_texts, op13_alignment
from tests.llm.data import ODD, documents, words

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
# Byte-level alphabet: printable Latin-1 stands for itself, the others are numbered from 256 on.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(x): x for x in PLAIN} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in PLAIN)}


def tokens(text):
    if not text:
        return [], []
    a = A.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(BYTE[c] for c in A.id_to_token(i))) for i in a]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(docs):
    aligned, count = [], Counter()
    for doc_id, text in docs:
        a, b = map(spans, tokens(text))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts, low = [], 0
        for high in cuts:
            parts.append("|".join(",".join(str(i) for i, _, e in side if low < e <= high) for side in (a, b)))
            low = high
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        aligned.append((doc_id, len(a), len(b), len(cuts), links, digest))
        count.update(set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return sorted(
        ((d, na, nb, g, len(x), sum(count[p] == best[p[0]] for p in x), sum(count[p] for p in x), h)
         for d, na, nb, g, x, h in aligned), key=str,
    )


def result(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def corpus(n=40):
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, rng.randint(1, 25), "abcdeéß漢字🙂 \n"))) for i in range(n)]
    odd = [(i, t if t is None or len(t) < 200 else "word " * 300) for i, t in ODD]
    marks = ["<s> <|endoftext|> </s>", " two  spaces", "▁ mark", "\ttab\x00nul", "é ﬁ Å", "a", "  ", "\n\n"]
    return rows + odd + [(500 + i, t) for i, t in enumerate(marks)]


@pytest.mark.parametrize("most", [0, 30, 1 << 18])
def test_equals_plain_version(spark, most):
    docs = corpus() + [(2000 + i, "the same text over and over") for i in range(30)] + [(2000, "the same text over and over")] * 20
    frame = documents(spark, docs).withColumn("key", F.lit("taken")).withColumn("n_a", F.lit(1.5)).repartition(4)
    assert result(alignment(frame, most=most)) == plain(docs)


def test_many_texts_of_few_copies_and_one_hot(spark, monkeypatch):
    monkeypatch.setattr("palaver.llm.alignment.SHARE", 4)
    docs = [(i, f"text {i % 37}") for i in range(80)] + [(None, "hot")] * 60 + [(1, None)] * 3
    assert result(alignment(documents(spark, docs))) == plain(docs)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, ""), (2, "▁")]])
def test_nothing_to_align(spark, docs):
    assert result(alignment(documents(spark, docs))) == plain(docs) == [(d, 0, 0, 0, 0, 0, 0, "") for d, _ in docs]


def test_each_distinct_text_once(spark):
    docs = documents(spark, [(i, f"t{i % 3}") for i in range(30)])
    assert sorted(r.copies for r in aligned_texts(docs).collect()) == [10, 10, 10]


def test_links_are_ends():
    n_a, n_b, groups, links, _, pairs, times = align(["An unbelievably long-winded sentence, naïvely tokenised"])[0]
    assert links == n_a + n_b - groups == times.sum() and len(pairs) == len(set(pairs.tolist()))


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = op13_alignment(spark, sf_dir)
    got, expected = result(out), plain_fast([tuple(r) for r in rows])
    assert got == expected
    assert dict(out.dtypes) == dict.fromkeys(COLUMNS[:-1], "bigint") | {"groups_sha256": "string"}


def plain_fast(docs):
    """As ``plain``, with links by merging the two sides, for long texts."""
    def links_of(a, b):
        i = j = 0
        while i < len(a) and j < len(b):
            yield a[i][0], b[j][0]
            end = min(a[i][2], b[j][2])
            i, j = i + (a[i][2] == end), j + (b[j][2] == end)

    aligned, count, best = [], Counter(), defaultdict(int)
    for doc_id, text in docs:
        a, b = map(spans, tokens(text))
        links, cuts = list(links_of(a, b)), {e for _, _, e in a} & {e for _, _, e in b}
        parts, sides = [], [[], []]
        ends = sorted([(e, 0, i) for i, _, e in a] + [(e, 1, i) for i, _, e in b])
        for k, (e, side, i) in enumerate(ends):
            sides[side].append(str(i))
            if e in cuts and (k + 1 == len(ends) or ends[k + 1][0] > e):
                parts.append("|".join(map(",".join, sides)))
                sides = [[], []]
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        aligned.append((doc_id, len(a), len(b), len(cuts), links, digest))
        count.update(set(links))
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return sorted(
        ((d, na, nb, g, len(x), sum(count[p] == best[p[0]] for p in x), sum(count[p] for p in x), h)
         for d, na, nb, g, x, h in aligned), key=str,
    )
