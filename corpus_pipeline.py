"""A training corpus from ``documents``: five stages, each on what the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns rows; ``run`` writes them as Parquet in the shared
scratch folder and reads them again as the next stage's documents. The first four return the columns
of documents; the last returns the mixture (doc_id, source, size, source_size, target, taken).

Null and empty texts fail the base rule of the first stage. Rows are kept or dropped whole. Of a group
of linked texts the row with the smallest id stays; of rows with equal ids and texts, one. Empty tables give
empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.llm import decontamination, language_id, mixture, ngram_join, quality_rules
from celluloid.llm.common import staged, table
from celluloid.llm.queries import benchmark_items

WEIGHTS, REPEATS = (1.0, 2.0, 3.0), 3.0
WIDTH, PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rule and the learned decision list keep."""
    return quality_rules.judge(docs, table(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is decided; its dictionaries are learned from the rows at hand."""
    contents = language_id.learn_dictionaries(language_id.sample_texts(docs, F.col("doc_id").isNotNull()))
    return language_id.identify(docs, contents).where(~F.col("rejected")).select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that links of five-word shingles at 0.8 connect."""
    return ngram_join.representatives(docs, WIDTH, PERCENT)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark passage."""
    return decontamination.clean(docs, benchmark_items(spark, sf_dir)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources at their target weights."""
    return mixture.mix(docs, WEIGHTS, REPEATS)


STAGES = [
    ("quality rules", keep_quality),
    ("language ID", keep_identified),
    ("n-gram Jaccard join", keep_one_of_group),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing sources to target weights", mix_sources),
]

ORACLE_SQL = None  # the learned stages have no SQL; tests hold the run against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
