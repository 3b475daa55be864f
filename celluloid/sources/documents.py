"""Scans of JSON landing files: movie-id exports, movie details and the knowledge-base dump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.functions.parse import clean_dump_line, flag
from celluloid.functions.variant import text_member
from celluloid.sources.tsv import ORDER

# Shapes of an export line and of a movie-detail document.
EXPORT_LINE = "id bigint, adult boolean, original_title string, popularity double, video boolean"
MOVIE_DETAILS = (
    "id bigint, title string, original_title string, original_language string, overview string, "
    "release_date string, runtime bigint, status string, popularity double, vote_average double, "
    "vote_count bigint, imdb_id string, external_ids struct<imdb_id: string>, "
    "credits struct<cast: array<struct<id: bigint, name: string, character: string, order: bigint, "
    "known_for_department: string>>, crew: array<struct<id: bigint, name: string, department: string, "
    "job: string>>>"
)


def _blank() -> Column:
    return F.trim("value") == ""


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


def _required(condition: Column, message: str, value: Column) -> Column:
    """The value, or a failed job where the condition does not hold.

    Filters may be evaluated in any order, so blank lines are told apart here too.
    """
    failed = F.raise_error(F.lit(message)).cast("bigint")
    return F.when(condition, value).when(~_blank(), failed)


def _strict_json(col: Column, ddl: str) -> Column:
    return F.from_json(col, ddl, {"mode": "FAILFAST"})


def scan_movie_export(spark: SparkSession, path, artifact_id: int) -> DataFrame:
    """Export lines; blank lines are skipped, a malformed or incomplete one fails the scan."""
    lines = _lines(spark, path).where(~_blank())
    rows = lines.select("value", _strict_json(F.col("value"), EXPORT_LINE).alias("r"), *ORDER)
    whole = F.col("r.id").isNotNull() & F.col("r.adult").isNotNull() & F.col("r.video").isNotNull()
    return rows.select(
        F.lit(artifact_id).cast("bigint").alias("export_artifact_id"),
        _required(whole, "export line lacks id, adult or video", F.col("r.id")).alias("tmdb_movie_id"),
        flag(F.col("r.adult")).alias("adult"),
        F.col("r.original_title").alias("original_title"),
        F.col("r.popularity").alias("popularity"),
        flag(F.col("r.video")).alias("video"),
        *ORDER,
    )


def parse_movie_details(lines: DataFrame) -> DataFrame:
    """Documents from a ``value`` column: one ``doc`` struct per row. Required members are checked."""
    docs = lines.where(~_blank()).withColumn("doc", _strict_json(F.col("value"), MOVIE_DETAILS))
    doc = F.col("doc")
    credits = doc["credits"]

    def complete(people: Column) -> Column:
        return people.isNotNull() & F.forall(people, lambda p: p["id"].isNotNull() & p["name"].isNotNull())

    whole = doc["id"].isNotNull() & doc["title"].isNotNull()
    whole = whole & (credits.isNull() | (complete(credits["cast"]) & complete(credits["crew"])))
    checked = _required(whole, "movie document lacks a required member", doc["id"])
    rest = [c for c in docs.columns if c not in ("value", "doc")]
    return docs.select(checked.alias("tmdb_movie_id"), "doc", *rest)


def scan_movie_details(spark: SparkSession, path) -> DataFrame:
    """Landed detail documents, one JSON document per line."""
    return parse_movie_details(_lines(spark, path))


def scan_entity_dump(spark: SparkSession, path) -> DataFrame:
    """Items of a knowledge-base dump: (wikidata_id, doc, order columns).

    The dump is a JSON array with one entity per line. Malformed JSON fails the scan; lines that
    are not items, or have no text id, are left out.
    """
    lines = _lines(spark, path).withColumn("value", F.regexp_replace("value", r"(?U)^\s+|\s+$", ""))
    is_entity = ~F.col("value").isin("", "[", "]")
    # later filters may be evaluated before this one: other lines must not reach the parser
    doc = F.when(is_entity, F.parse_json(clean_dump_line(F.col("value"))))
    docs = lines.where(is_entity).select(doc.alias("doc"), *ORDER)
    items = docs.where(text_member(F.col("doc"), "$.type") == "item")
    named = items.withColumn("wikidata_id", text_member(F.col("doc"), "$.id"))
    return named.where(F.col("wikidata_id").isNotNull()).select("wikidata_id", "doc", *ORDER)
