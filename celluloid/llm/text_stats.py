"""Statistics of one text, counted in one pass; used by the quality operators."""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import cache

import numpy as np

from celluloid.llm.common import words

# The six characters that part words, and the symbol characters.
SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

FIELDS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_letters",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_sentence_ends",
)


@cache
def _kinds() -> np.ndarray:
    """Per code point: 1 lower or uncased letter, 2 upper-case letter, 3 digit, 4 punctuation or symbol, else 0."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        if category in ("Lu", "Lt"):
            kinds[point] = 2
        elif category[0] == "L":
            kinds[point] = 1
        elif category[0] == "N":
            kinds[point] = 3
        elif category[0] in "PS":
            kinds[point] = 4
    return kinds


def repeated_words(found: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more in the text, each word once."""
    if len(found) < 4:
        return 0
    windows = list(zip(found, found[1:], found[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    hit = np.fromiter(map(seen.__getitem__, windows), dtype=np.int64, count=len(windows)) > 1
    covered = np.zeros(len(found), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of ``FIELDS``; a null or empty text has zeros."""
    if not text:
        return (0,) * len(FIELDS)
    found = words(text)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    kinds = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)], minlength=5)
    return (
        len(found),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(found),
        len(lines),
        len(set(found)),
        int(kinds[1] + kinds[2]),
        int(kinds[2]),
        int(kinds[3]),
        int(kinds[4]),
        sum(map(text.count, ".!?")),
    )
