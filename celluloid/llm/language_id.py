"""Language identification by compression.

One zstandard raw-content dictionary per language holds the words that occur in most sample texts of
that language, the most frequent last, where matches are cheapest. (Whole sample texts would do
worse: a passage that happens to be in one dictionary decides for every text that quotes it.) A text
is reduced to its lower-cased letters and single spaces, cut into blocks of at most ``BLOCK`` bytes,
and each block is compressed with every dictionary; the language whose dictionary gives the smallest
sum of sizes is chosen. When the second sum is no more than ``NARROW`` larger than the best, the
decision is marked as rejected, unless it is a tie that a text of under ``SHORT`` bytes cannot avoid.

The dictionaries are learned from a bounded sample: at most ``SAMPLE_ROWS`` rows a language, a fixed
pseudo-random choice.

Edge cases: a null text, and one without a letter, is ``und`` with score 0 and rejected. Rows whose
language or id is null teach nothing; with nothing to learn from, every row is ``und``. Equal sums:
the language with more learning rows. Repeated rows stay; other columns pass through unless named
lang_pred, score or rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celluloid.llm.common import ship, spread

SAMPLE_ROWS = 400  # bound on the rows of a language that its dictionary is made from
DICT_BYTES = 48 << 10
BLOCK = 4 << 10
LEVEL = 8
NARROW = 0.002
SHORT = 400
UNDETERMINED = "und"
MAX_LANGUAGES = 1000  # dictionaries of more would not fit beside each other in a worker

NOT_LETTERS = regex.compile(r"\P{L}+")


def plain(text: str) -> str:
    """Lower-cased letters; anything else is one space."""
    return NOT_LETTERS.sub(" ", text.lower())


def sample_texts(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` (lang, text) of each language; a frequent language is thinned before it is ranked."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("_rows")).orderBy(F.desc("_rows"), "lang").limit(MAX_LANGUAGES)
    place = F.pmod(spread("doc_id"), F.lit(1_000_000)) / 1_000_000
    thinned = known.select("doc_id", "lang", "text").join(F.broadcast(sizes), "lang").where(place * F.col("_rows") < 4 * rows)
    ranked = Window.partitionBy("lang").orderBy(spread("doc_id"), "doc_id", "text")
    return thinned.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= rows).select("lang", "_rows", "text")


def learn_dictionaries(samples: DataFrame) -> dict[str, bytes]:
    """Raw dictionary content by language, the language with most learning rows first."""
    texts = samples.toPandas()
    order = texts.groupby("lang")["_rows"].max()
    made = {}
    for language in sorted(order.index, key=lambda c: (-order[c], c)):
        found: Counter[str] = Counter()
        for text in set(texts.loc[texts["lang"] == language, "text"]):
            found.update(set(plain(text).split()))
        shared = {w: n for w, n in found.items() if n > 1} or found
        content, size = [], 0
        for word in sorted(shared, key=lambda w: (-shared[w], w)):
            size += len(word.encode()) + 1
            if size > DICT_BYTES:
                break
            content.append(word)
        if content:
            made[language] = " ".join(reversed(content)).encode()
    return made


class Classifier:
    def __init__(self, contents: dict[str, bytes]):
        self.languages = list(contents)
        self.compressors = []
        for language in self.languages:
            content = zstandard.ZstdCompressionDict(contents[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, data: bytes) -> np.ndarray:
        """Compressed bytes by language."""
        total = np.zeros(len(self.languages), dtype=np.int64)
        for at in range(0, len(data), BLOCK):
            block = data[at : at + BLOCK]
            total += [len(c.compress(block)) for c in self.compressors]
        return total

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        data = plain(text).strip().encode() if text else b""
        if not self.languages or not data:
            return UNDETERMINED, 0.0, True
        sizes = self.sizes(data)
        best = int(np.argmin(sizes))
        score = float(1.0 / np.exp2(-(sizes - sizes[best]).clip(0, 60).astype(float)).sum())
        if len(sizes) == 1 or len(data) < SHORT:
            return self.languages[best], score, False
        second = np.partition(sizes, 1)[1]
        return self.languages[best], score, bool(second - sizes[best] < NARROW * sizes[best])


def identify(docs: DataFrame, contents: dict[str, bytes]) -> DataFrame:
    """The rows with lang_pred, score and rejected."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(contents)  # MAX_LANGUAGES x DICT_BYTES at most
    schema = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classifier = Classifier(held.value)
        for texts in batches:
            yield pd.DataFrame([classifier.decide(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    decided = docs.withColumn("_decided", F.pandas_udf(decide, schema).asNondeterministic()("text"))
    return decided.withColumns({c: F.col(f"_decided.{c}") for c in schema.names}).drop("_decided")
