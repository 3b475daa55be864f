"""Index of the parts of names, for lookups by any part.

Every three neighbouring characters of a name are a gram. The index has postings (gram, bucket, id), cut by range
of the gram, and a copy of the named records in folders by bucket, a hash of the id. A pattern's literal
pieces, between its wildcards, must all occur in a name that matches; so the ids that have all grams of the
pieces are found in few posting files, and only the folders of their buckets are read, where the pattern
itself decides. Which folders those are is a subquery of the read: no job runs before the lookup does.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
BUCKETS = 64


def folded(col: Column) -> Column:
    """Lower case of ASCII letters only, as LIKE compares them."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def grams(col: Column) -> Column:
    """Distinct grams of a text; null and shorter texts have none."""
    text = folded(col)
    last = F.char_length(text) - (GRAM - 1)
    parts = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.when(last >= 1, F.array_distinct(parts))


def pattern_grams(pattern: str) -> list[str]:
    """Grams that a text must have to match ``%`` + pattern + ``%``; empty when the pattern is too short to tell."""
    text = "".join(c.lower() if c in string.ascii_uppercase else c for c in pattern)
    pieces = re.split("[%_]", text)
    return sorted({piece[i : i + GRAM] for piece in pieces for i in range(len(piece) - GRAM + 1)})


class NameIndex:
    """Postings (gram, bucket, id) and records by bucket."""

    def __init__(self, postings: DataFrame, records: DataFrame, key: str, buckets: int):
        self.postings, self.records, self.key, self.buckets = postings, records, key, buckets

    @classmethod
    def build(cls, records: DataFrame, key: str, names: Sequence[str], buckets: int = BUCKETS) -> NameIndex:
        """``records`` has one row per id in ``key``; ``names`` are the columns that lookups search."""
        placed = records.withColumn("bucket", _bucket(F.col(key), buckets))
        every = F.array_distinct(F.flatten(F.array_compact(F.array(*[grams(F.col(c)) for c in names]))))
        postings = placed.select(F.explode(every).alias("gram"), "bucket", F.col(key).alias("id"))
        return cls(postings, placed, key, buckets)

    def save(self, path: str) -> NameIndex:
        spark = self.records.sparkSession
        # made once: cutting by range looks at its input twice
        self.postings.write.mode("overwrite").parquet(f"{path}/unsorted")
        order = ("gram", "bucket", "id")
        cut = spark.read.parquet(f"{path}/unsorted").repartitionByRange(*order).sortWithinPartitions(*order)
        cut.write.mode("overwrite").parquet(f"{path}/postings")
        self.records.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/records")
        return NameIndex.load(spark, path, self.key, self.buckets)

    @classmethod
    def load(cls, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> NameIndex:
        return cls(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/records"), key, buckets)

    def candidates(self, pattern: str) -> DataFrame | None:
        """(id, bucket) of the names that have all grams of the pattern; None when it has no gram."""
        wanted = pattern_grams(pattern)
        if not wanted:
            return None
        found = self.postings.where(F.col("gram").isin(wanted)).groupBy("id", "bucket").agg(F.count("*").alias("grams"))
        return found.where(F.col("grams") == len(wanted)).select("id", "bucket")

    def may_match(self, query: str) -> DataFrame:
        """The records among which those with the id, or with the pattern in a name, are found."""
        found = self.candidates(query)
        if found is None:
            return self.records
        # at most as many numbers as there are buckets
        open_buckets = found.agg(F.collect_set("bucket")).scalar()
        own = _bucket(F.lit(query), self.buckets)
        return self.records.where(F.array_contains(open_buckets, F.col("bucket")) | (F.col("bucket") == own))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
