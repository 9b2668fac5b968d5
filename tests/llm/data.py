"""Small inputs of the operator tests."""

from __future__ import annotations

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, alphabet: str = "abcdefghij") -> list[str]:
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def learns(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 != 0


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [(None, "no id at all here"), (900_001, None), (900_002, ""), (900_003, "?! ..."), (900_004, "one"),
       (900_005, "same row twice"), (900_005, "same row twice"), (900_006, "word " * 60_000)]
