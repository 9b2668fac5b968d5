"""Sharding, URL rules and perspectives."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palaver.llm import perspectives, sharding, url_filter
from tests.llm.data import ODD, documents, words


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bucket_bytes", [2_000, 1 << 30])
def test_shards_hold_every_row_once(spark, bucket_bytes):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.randint(0, 30)))) for i in range(203)] + ODD
    docs = documents(spark, rows).withColumn("Slot", F.lit("mine")).withColumn("bucket", F.lit(3))
    got = sharding.shuffled(docs, 8, bucket_bytes=bucket_bytes)
    assert rows_of(got.select("doc_id", "text", "bucket")) == rows_of(docs.select("doc_id", "text", "bucket"))
    slots = {}
    for r in got.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(v) for v in slots.values()]
    assert len(slots) == 8 and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert rows_of(got) == rows_of(sharding.shuffled(docs.repartition(3), 8, bucket_bytes=bucket_bytes))


def test_order_is_shuffled(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(2000)])
    place = {r.doc_id: r.slot * 4 + r.shard for r in sharding.shuffled(docs, 4, bucket_bytes=50_000).collect()}
    moved = sum(place[i + 1] - place[i] == 1 for i in range(1999))
    assert moved < 20 and abs(sum(place[i] for i in range(1000)) / 1000 - 999.5) < 80


def test_written_shards_are_in_slot_order(spark, tmp_path):
    docs = documents(spark, [(i, f"text {i}") for i in range(50)])
    sharding.write_shards(docs, f"{tmp_path}/out", 3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 50 and {r.shard for r in back.collect()} == {0, 1, 2}
    assert sharding.shuffled(docs.limit(0), 3).count() == 0


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fit = []
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(rule), len(h), rule, verdict))
    best = max(fit, default=(0, 0, None, default))
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme", "http://", "https://Example.NET/en/x", "http://example.net", "http://a.b.example.com/de/1?q#f",
    "http://net/", "http://xnet/", "http://net", "http://.net/", "ftp://x.org/fr/y", "http://org/fr/", "http://x.org/fr",
    "http://u:p@example.com/de/", "http://example.com:80/de/", "http://x.net?y=/en/", "http://a://example.net/en/",
    "http://É.example.NET/en/ü", "http://example.com/de/\nline",
]


def test_url_rules_equal_the_plain_rule(spark):
    rng = random.Random(2)
    hosts = ["net", "org", "com", "example.net", "example.com", "a.example.net", "b.org", "xexample.com"]
    urls = URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', ''])}/{rng.randint(0, 9)}" for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, Host string")
    more = url_filter.RULES + (("example.com/de/7", "allow"), (None, "block"), ("b.org/", "block"))
    for rules in (url_filter.RULES, more, ()):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
        known = [r for r in rules if r[0]]
        assert got == {i: plain_verdict(u, known) for i, u in enumerate(urls)}


def test_cascade_is_exact_for_every_key(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    listed = keys.filter("CAST(substr(key, 2) AS INT) % 7 = 0")
    cascade = url_filter.build(listed, keys)
    assert len(cascade.levels) >= 3  # several levels were needed
    found = keys.filter(cascade.has(F.col("key")))
    assert found.exceptAll(listed).isEmpty() and listed.exceptAll(found).isEmpty()


def test_urls_of_an_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def plain_rotation(turns):
    out = []
    for conv in {t[0] for t in turns if t[0] is not None}:
        mine = [(t[1], (t[2] or "").strip(" ") or "unknown", t[3] or "") for t in turns if t[0] == conv]
        mine.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], len(t[2]), t[2].encode()))
        for who in {t[1] for t in mine} - {"system"}:
            at = 0
            for nth, (turn, speaker, text) in enumerate(mine):
                name = "system" if speaker == "system" else "assistant" if speaker == who else f"user name={speaker}"
                segment = f"<|im_start|>{name}\n{text}<|im_end|>\n"
                mask = (at + 22, at + len(segment)) if name == "assistant" else (None, None)
                out.append((conv, who, nth, turn, speaker, name, segment, at, *mask))
                at += len(segment)
    return out


def test_every_speaker_is_the_assistant_once(spark):
    rng = random.Random(3)
    turns = [
        (rng.randrange(6), rng.choice([None, *range(600)]), rng.choice(["user", "assistant", "system", "Ann", " ", None]),
         rng.choice([None, "", " ".join(words(rng, rng.randint(1, 30), "abé"))]))
        for _ in range(400)
    ]
    turns += [(7, 1, "user", "same")] * 3 + [(8, 1, "system", "alone"), (None, 1, "user", "x"), (9, 5, "Bob", "y" * 100_000)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("start", F.lit(1))
    got = perspectives.rotate(frame)
    assert Counter(map(tuple, got.collect())) == Counter(plain_rotation(turns))
    assert perspectives.rotate(frame.limit(0)).count() == 0


def test_no_python_in_the_plans(spark, tmp_path):
    docs = documents(spark, [(1, "a")])
    turns = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    for df in (sharding.shuffled(docs, 2), perspectives.rotate(turns), url_filter.judge(pages)):
        assert "Python" not in df._jdf.queryExecution().toString()
