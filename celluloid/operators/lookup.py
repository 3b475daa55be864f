"""Title and person lookups by id or by part of a name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celluloid.functions.text import id_or_like
from celluloid.operators.names import NameIndex
from celluloid.operators.relational import top_people, top_titles

TITLE_RECORD = (
    "imdb_id",
    "primary_title",
    "original_title",
    "title_type",
    "start_year",
    "runtime_minutes",
    "genres",
)
PERSON_RECORD = ("imdb_name_id", "primary_name", "birth_year", "death_year", "primary_professions")


def title_names(titles: DataFrame, **options) -> NameIndex:
    return NameIndex.build(titles.select(*TITLE_RECORD), "imdb_id", ["primary_title", "original_title"], **options)


def person_names(people: DataFrame, **options) -> NameIndex:
    return NameIndex.build(people.select(*PERSON_RECORD), "imdb_name_id", ["primary_name"], **options)


def lookup_title(titles: DataFrame | NameIndex, query: str, n: int = 20) -> DataFrame:
    """By id or by part of a title; a name index reads only where the part occurs."""
    titles = titles.may_match(query) if isinstance(titles, NameIndex) else titles
    names = [F.col("primary_title"), F.col("original_title")]
    hits = titles.where(id_or_like(F.col("imdb_id"), names, query))
    return top_titles(hits.select(*TITLE_RECORD), n)


def lookup_person(people: DataFrame | NameIndex, query: str, n: int = 20) -> DataFrame:
    people = people.may_match(query) if isinstance(people, NameIndex) else people
    hits = people.where(id_or_like(F.col("imdb_name_id"), [F.col("primary_name")], query))
    return top_people(hits.select(*PERSON_RECORD), n)
