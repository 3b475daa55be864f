"""Scans of the bulk tab-separated landing files.

The files have a header and no quoting; columns are matched by header name. ``\\N`` marks a null
only in the columns that allow it. A row with the wrong number of fields fails the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celluloid.functions.parse import default, null_sentinel, parse_double, parse_long

# Order of arrival. Partition ids alone do not follow the offsets of a split plain file.
ORDER = ("_file", "_block", "_line")


def scan_tsv(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """Raw text columns by header name, plus the order columns; an empty field is ``''``."""
    # The CSV reader turns empty fields into nulls, and nullValue cannot be empty,
    # so a control character is taken as null marker and empties are put back.
    raw = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("nullValue", "\u0001")
        .option("mode", "FAILFAST")
        # a ragged row must fail the scan even when a later projection drops the columns
        .option("columnPruning", False)
        .csv(path)
    )
    return raw.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


def arrived(staged: DataFrame) -> DataFrame:
    """Staged rows with one number of arrival in place of the order columns: the place of the row's split among
    all splits, by file and block, and the line within it."""
    splits = staged.select("_file", "_block").distinct()
    ranked = splits.withColumn("_split", F.row_number().over(Window.orderBy("_file", "_block")).cast("long"))
    line = F.col("_line").bitwiseAND(F.lit((1 << 33) - 1))
    number = F.shiftleft(F.col("_split"), 33).bitwiseOR(line)
    # as many rows as the reader had splits; unless told so, Spark takes them for as large as what they are made from and
    # shuffles all staged rows
    return staged.join(F.broadcast(ranked), ["_file", "_block"]).withColumn("_arrival", number).drop("_split", *ORDER)


def _text(name: str) -> Column:
    return F.col(name)


def _optional(name: str) -> Column:
    return null_sentinel(F.col(name))


def _long(name: str) -> Column:
    return parse_long(_optional(name))


def _double(name: str) -> Column:
    return parse_double(_optional(name))


def _flag(name: str) -> Column:
    return default(_long(name), 0)


# Per dataset, (file header, table column, parse rule).
LAYOUTS = {
    "name.basics": (
        ("nconst", "imdb_name_id", _text),
        ("primaryName", "primary_name", _text),
        ("birthYear", "birth_year", _long),
        ("deathYear", "death_year", _long),
        ("primaryProfession", "primary_professions", _optional),
        ("knownForTitles", "known_for_titles", _optional),
    ),
    "title.basics": (
        ("tconst", "imdb_id", _text),
        ("titleType", "title_type", _text),
        ("primaryTitle", "primary_title", _text),
        ("originalTitle", "original_title", _optional),
        ("isAdult", "is_adult", _flag),
        ("startYear", "start_year", _long),
        ("endYear", "end_year", _long),
        ("runtimeMinutes", "runtime_minutes", _long),
        ("genres", "genres", _optional),
    ),
    "title.ratings": (
        ("tconst", "imdb_id", _text),
        ("averageRating", "average_rating", _double),
        ("numVotes", "num_votes", _long),
    ),
    "title.akas": (
        ("titleId", "imdb_id", _text),
        ("ordering", "ordering", _long),
        ("title", "title", _text),
        ("region", "region", _optional),
        ("language", "language", _optional),
        ("types", "types", _optional),
        ("attributes", "attributes", _optional),
        ("isOriginalTitle", "is_original_title", _long),
    ),
    "title.crew": (
        ("tconst", "imdb_id", _text),
        ("directors", "directors", _optional),
        ("writers", "writers", _optional),
    ),
    "title.principals": (
        ("tconst", "imdb_id", _text),
        ("ordering", "ordering", _long),
        ("nconst", "imdb_name_id", _text),
        ("category", "category", _text),
        ("job", "job", _optional),
        ("characters", "characters", _optional),
    ),
    "title.episode": (
        ("tconst", "imdb_id", _text),
        ("parentTconst", "parent_imdb_id", _text),
        ("seasonNumber", "season_number", _long),
        ("episodeNumber", "episode_number", _long),
    ),
}


def scan_dataset(spark: SparkSession, path: str | list[str], dataset: str) -> DataFrame:
    """Typed rows of one dataset with the order columns."""
    layout = LAYOUTS[dataset]
    raw = scan_tsv(spark, path, [header for header, _, _ in layout])
    return raw.select(*[rule(header).alias(name) for header, name, rule in layout], *ORDER)


def scan_people(spark: SparkSession, path) -> DataFrame:
    return scan_dataset(spark, path, "name.basics")


def scan_titles(spark: SparkSession, path) -> DataFrame:
    return scan_dataset(spark, path, "title.basics")


def scan_ratings(spark: SparkSession, path) -> DataFrame:
    return scan_dataset(spark, path, "title.ratings")


def scan_akas(spark: SparkSession, path) -> DataFrame:
    return scan_dataset(spark, path, "title.akas")


def scan_crew(spark: SparkSession, path) -> DataFrame:
    return scan_dataset(spark, path, "title.crew")


def scan_principals(spark: SparkSession, path) -> DataFrame:
    return scan_dataset(spark, path, "title.principals").withColumn("source", F.lit("imdb"))


def scan_episodes(spark: SparkSession, path) -> DataFrame:
    return scan_dataset(spark, path, "title.episode")
