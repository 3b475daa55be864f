"""Sinks: N-Quads lines, the graph profile, JSON rows, triples and search indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.schema import TRIPLE_SCHEMA, XSD


def _escape(col: Column) -> Column:
    """Escapes of a quoted RDF literal."""
    # Characters that must be escaped, and their escapes.
    for char, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        col = F.replace(col, F.lit(char), F.lit(escaped))
    return col


def _node(col: Column) -> Column:
    return F.concat(F.lit("<"), col, F.lit(">"))


def nquads_lines(triples: DataFrame) -> DataFrame:
    """One N-Quads line per triple of the default graph, column ``value``."""
    quoted = F.concat(F.lit('"'), _escape(F.col("o")), F.lit('"'))
    typed = F.concat(quoted, F.lit(f"^^<{XSD}"), F.col("o_type"), F.lit(">"))
    literal = F.when(F.col("o_type") == "string", quoted).otherwise(typed)
    term = F.when(F.col("o_kind") == "iri", _node(F.col("o"))).otherwise(literal)
    return triples.select(F.concat_ws(" ", _node(F.col("s")), _node(F.col("p")), term, F.lit(".")).alias("value"))


def write_nquads(triples: DataFrame, path: str) -> None:
    nquads_lines(triples).write.mode("overwrite").text(path)


def save_triples(triples: DataFrame, path: str, cut: bool = False) -> None:
    """One folder per predicate, sorted by subject: patterns read the folders of their predicates.

    The rows are cut by range of (p, s, o): frequent predicates get several files, each with a range of
    subjects that its footer tells. Rows that are ``cut`` so already are written as they lie.
    """
    even = (triples if cut else triples.repartitionByRange("p", "s", "o")).sortWithinPartitions("p", "s", "o")
    even.write.mode("overwrite").option("compression", "zstd").partitionBy("p").parquet(path)
    edges = load_triples(triples.sparkSession, path).where(F.col("o_kind") == "iri")
    edges = edges.repartitionByRange("o", "p", "s").sortWithinPartitions("o", "p", "s")
    edges.write.mode("overwrite").option("compression", "zstd").parquet(_by_object(path))


def _by_object(path: str) -> str:
    return f"{path.rstrip('/')}-by-object"


def load_edges_by_object(spark: SparkSession, path: str) -> DataFrame:
    """Triples whose object is a node, laid out by object, of the triples saved at ``path``."""
    return spark.read.schema(TRIPLE_SCHEMA).parquet(_by_object(path)).select(*TRIPLE_SCHEMA.names)


def load_triples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIPLE_SCHEMA).parquet(path).select(*TRIPLE_SCHEMA.names)


def table_bytes(df: DataFrame) -> DataFrame:
    """``store_bytes``: bytes of the files a table is read from."""
    files = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).distinct()
    return files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("store_bytes"))


def save_profile(profile: DataFrame, path: str) -> None:
    """Write the profile rows (metric, name, value) as JSON."""
    profile.write.mode("overwrite").json(path)


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("metric string, name string, value bigint").json(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as a JSON object, column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
