from __future__ import annotations

import itertools
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def pool(*syllables: str) -> list[str]:
    return ["".join(p) for p in itertools.product(syllables, repeat=4)]


WORDS = pool("ka", "to", "mi", "re", "sun", "dor", "le", "pi")


def sentences(seed: int, count: int, vocabulary: list[str] | None = None) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary or WORDS) for _ in range(count))


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)
