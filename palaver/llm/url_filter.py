"""URL block and allow rules by a cascade of Bloom filters: exact membership without a join.

A rule is a host and a path prefix (``example.net/en/``); it fits its host and all subdomains where the path starts with
its path, and the longest fitting rule decides. Which rules fit is asked of keys: the last labels of the host (as many as
some rule has) with the first characters of the path (as many as some rule has).

The cascade knows all keys that can be asked, those of the corpus. Its first filter holds the listed keys, the second
those unlisted keys of the corpus that the first lets through, the third those listed keys that the second lets through,
and so on until a filter lets nothing wrong through. The number of filters a key passes then tells membership exactly,
for every key of the corpus. Filters are arrays of 64-bit words built by ``bit_or``; each level is one pass over what the
level before let through, a small part of the keys.

Defined results: a url that is null or lacks ``://`` has empty host and path, and no rule fits; where no rule fits, the
verdict is ``allow``. Of equally long rules the one with the longer host decides. Rules with a null part are skipped.
Columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import table, without, written

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DEFAULT = "allow"
BITS_PER_KEY = 8
HASHES = 4


@dataclass(frozen=True)
class Level:
    """One filter: 64-bit words, number of bits and the seed of its hashes."""

    words: list[int]
    bits: int
    seed: int

    def has(self, key: Column) -> Column:
        words = F.from_json(F.lit(str(self.words)), "array<bigint>")  # one literal, folded when the query is planned
        hits = []
        for bit in _bits(key, self.bits, self.seed):
            word = F.get(words, F.floor(bit / 64).cast("int"))
            shifted = F.call_function("shiftright", word, (bit % 64).cast("int"))
            hits.append(shifted.bitwiseAND(F.lit(1)) == 1)
        return reduce(lambda a, b: a & b, hits)


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def has(self, key: Column) -> Column:
        """Membership of a key of the corpus: it fails a filter of unlisted keys, or passes all filters of listed ones."""
        inside = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            inside = F.when(self.levels[i].has(key), inside).otherwise(F.lit(i % 2 == 1))
        return inside


def _bits(key: Column, bits: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * HASHES + k)), F.lit(bits)) for k in range(HASHES)]


def _level(keys: DataFrame, n: int, seed: int) -> Level:
    """A filter over the ``n`` keys; only its words come to the driver, ``BITS_PER_KEY`` bits for each key."""
    bits = 64 * max(1, -(-n * BITS_PER_KEY // 64))
    places = keys.select(F.explode(F.array(*_bits(F.col("key"), bits, seed))).alias("bit"))
    word = F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")
    got = places.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(word).alias("word")).toArrow()
    words = [0] * (bits // 64)
    for at, value in zip(got["at"].to_pylist(), got["word"].to_pylist()):
        words[at] = value
    return Level(words, bits, seed)


def build(listed: DataFrame, corpus: DataFrame) -> Cascade:
    """Cascade for ``listed`` keys, exact for every key of ``corpus`` (both: distinct, column ``key``)."""
    inside, outside = listed, corpus.join(listed, "key", "left_anti")
    out, n = Cascade(), inside.count()
    while n:
        level = _level(inside, n, len(out.levels))
        out.levels.append(level)
        inside, outside = written(outside.filter(level.has(F.col("key"))), "passed"), inside
        n = inside.count()
    return out


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _shape(rule: str) -> tuple[int, int]:
    host, slash, path = rule.partition("/")
    return len(host.split(".")), len(slash + path)


def candidates(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> list[Column]:
    """For each shape (host labels, path characters), the key that a rule of it has if it fits; else null."""
    keys = []
    for labels, length in shapes:
        last = F.substring_index(host, ".", -labels)
        long_enough = (F.size(F.split(host, r"\.")) >= labels) & (F.length(path) >= length) & (host != "")
        keys.append(F.when(long_enough, F.concat(last, F.substring(path, 1, length))))
    return keys


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """``pages`` (url) with host, path, rule and verdict."""
    pages = without(pages, ["host", "path", "rule", "verdict"])
    spark = pages.sparkSession
    rules = [(r, v) for r, v in rules if r and v]
    parts = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    if not rules:
        return parts.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    shapes = sorted({_shape(r) for r, _ in rules})
    keys = candidates(F.col("host"), F.col("path"), shapes)
    asked = parts.select(F.explode(F.array_compact(F.array(*keys))).alias("key"))
    corpus = written(asked.distinct(), "keys")
    cascades = {
        v: build(spark.createDataFrame([(r,) for r, w in rules if w == v], "key string").distinct(), corpus)
        for v in sorted({v for _, v in rules})
    }

    def fitting(key: Column) -> Column:
        """(length, host length, key, verdict) of a listed key, null for others."""
        verdict = F.coalesce(*[F.when(c.has(key), F.lit(v)) for v, c in cascades.items()])
        rank = F.struct(
            F.length(key).alias("length"), F.instr(key, "/").alias("host"), key.alias("rule"), verdict.alias("verdict")
        )
        return F.when(verdict.isNotNull(), rank)

    out = parts.withColumn("_best", F.array_max(F.array(*[fitting(k) for k in keys])))
    return out.withColumn("rule", F.col("_best.rule")).withColumn(
        "verdict", F.coalesce("_best.verdict", F.lit(default))
    ).drop("_best")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


ORACLE_SQL = """
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(split_part_rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(split_part_rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM (SELECT page_id, url, substr(url, strpos(url, '://') + 3) AS split_part_rest FROM pages)
),
rules(rule, rule_host, rule_path, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
),
fits AS (
  SELECT p.*, r.rule, r.verdict AS rule_verdict,
    row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.rule) DESC NULLS LAST) AS nth
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE nth = 1
"""
