"""Rows out of knowledge-base documents and movie-detail documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celluloid.functions.text import credit_key, raw_json
from celluloid.functions.variant import claim_map, claim_value, localized, text_member
from celluloid.schema import CLAIM_PROPERTIES, EXTERNAL_ID_PROPERTY
from celluloid.sources.tsv import ORDER


def prepare_items(items: DataFrame, language: str) -> DataFrame:
    """What an import needs of each item: texts in one language and the statements it reads.

    (wikidata_id, label, description, claims, order columns), with ``claims`` cut down to the
    selected properties. Staged in this shape, a dump is parsed once.
    """
    doc = F.col("doc")
    wanted = [EXTERNAL_ID_PROPERTY, *CLAIM_PROPERTIES]
    return items.select(
        "wikidata_id",
        localized(doc, "labels", language).alias("label"),
        localized(doc, "descriptions", language).alias("description"),
        F.map_filter(claim_map(doc), lambda k, v: k.isin(wanted)).alias("claims"),
        *ORDER,
    )


def entity_rows(items: DataFrame) -> DataFrame:
    """(wikidata_id, label, description, entity_type) with the order columns."""
    return items.select("wikidata_id", "label", "description", F.lit("item").alias("entity_type"), *ORDER)


def external_ids(items: DataFrame, prop: str = EXTERNAL_ID_PROPERTY) -> DataFrame:
    """(wikidata_id, external_id, _pos) of the text values of one property, in statement order."""
    statements = F.try_element_at(F.col("claims"), F.lit(prop))
    rows = items.select("wikidata_id", *ORDER, F.posexplode(statements).alias("_pos", "statement"))
    named = rows.withColumn("external_id", text_member(F.col("statement"), "$.mainsnak.datavalue.value"))
    return named.where(F.col("external_id").isNotNull()).drop("statement")


def explode_claims(items: DataFrame, properties: Sequence[str] = CLAIM_PROPERTIES) -> DataFrame:
    """Readable statements of the selected properties.

    ``ordinal`` counts from 0 over all statements of a property, unreadable ones included.
    """
    by_property = items.select(
        F.col("wikidata_id").alias("subject_wikidata_id"),
        *ORDER,
        F.explode("claims").alias("property_id", "statements"),
    ).where(F.col("property_id").isin(list(properties)))
    statements = by_property.select(
        "subject_wikidata_id", *ORDER, "property_id", F.posexplode("statements").alias("ordinal", "statement")
    )
    statement = F.col("statement")
    rows = statements.withColumn("_value", claim_value(statement)).where(F.col("_value").isNotNull())
    return rows.select(
        "subject_wikidata_id",
        "property_id",
        "_value.*",
        text_member(statement, "$.mainsnak.datatype").alias("datatype"),
        text_member(statement, "$.rank").alias("rank_name"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
        raw_json(statement).alias("raw_json"),
        *ORDER,
    )


def external_id(doc: Column) -> Column:
    """Film-database id of a movie document: the one under ``external_ids`` comes first."""
    return F.coalesce(doc["external_ids"]["imdb_id"], doc["imdb_id"])


def movie_rows(details: DataFrame) -> DataFrame:
    """Movie records of detail documents, without the hydration time."""
    doc = F.col("doc")
    rest = [c for c in details.columns if c not in ("tmdb_movie_id", "doc")]
    return details.select(
        "tmdb_movie_id",
        external_id(doc).alias("imdb_id"),
        *[doc[c].alias(c) for c in ("title", "original_title", "original_language", "overview", "release_date")],
        doc["runtime"].alias("runtime_minutes"),
        *[doc[c].alias(c) for c in ("status", "popularity", "vote_average", "vote_count")],
        raw_json(doc).alias("raw_json"),
        *rest,
    )


def explode_credits(details: DataFrame) -> DataFrame:
    """Cast and crew rows of detail documents; cast comes before crew, each in list order."""
    rest = [c for c in details.columns if c not in ("tmdb_movie_id", "doc")]
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def entry(person: Column, kind: str, key: Column, order: Column, department: str, job: Column, role: Column):
        return F.struct(
            person["id"].alias("tmdb_person_id"),
            person["name"].alias("name"),
            key.alias("credit_key"),
            order.alias("cast_order"),
            F.lit(kind).alias("credit_kind"),
            person[department].alias("department"),
            job.alias("job"),
            role.alias("character_name"),
            raw_json(person).alias("raw_json"),
        )

    def cast_entry(c: Column) -> Column:
        key = credit_key("cast", c["id"], F.coalesce(c["order"], F.lit(0)), c["character"])
        return entry(c, "cast", key, c["order"], "known_for_department", no_text, c["character"])

    def crew_entry(c: Column) -> Column:
        key = credit_key("crew", c["id"], c["department"], c["job"])
        return entry(c, "crew", key, no_number, "department", c["job"], no_text)

    people = F.concat(
        F.transform("doc.credits.cast", cast_entry), F.transform("doc.credits.crew", crew_entry)
    )
    rows = details.select("tmdb_movie_id", *rest, F.posexplode(people).alias("_pos", "c"))
    return rows.select("tmdb_movie_id", "c.*", *rest, "_pos")
