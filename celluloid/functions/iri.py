"""IRIs of titles, people, entities, properties and local predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from celluloid.functions.text import any_of
from celluloid.schema import (
    DEFAULT_BASE_IRI,
    ENTITY_BASE,
    PROPERTY_BASE,
    RDF_TYPE,
    SCHEMA_ORG,
    SCHEMA_ORG_PREDICATES,
)


class Vocabulary:
    """IRI builders under one local base IRI."""

    def __init__(self, base_iri: str = DEFAULT_BASE_IRI):
        self.base = base_iri
        self.title_base = f"{base_iri}title/"
        self.person_base = f"{base_iri}person/"
        self.type = RDF_TYPE
        self.movie = f"{SCHEMA_ORG}Movie"
        self.person = f"{SCHEMA_ORG}Person"

    def predicate(self, name: str) -> str:
        """Full IRI of a predicate given by its short name."""
        if name == "type":
            return RDF_TYPE
        if name in SCHEMA_ORG_PREDICATES:
            return SCHEMA_ORG + name
        return self.base + sanitize_name(name)

    def title_iri(self, col: Column) -> Column:
        return F.concat(F.lit(self.title_base), col)

    def person_iri(self, col: Column) -> Column:
        return F.concat(F.lit(self.person_base), col)

    def entity_iri(self, col: Column) -> Column:
        return F.concat(F.lit(ENTITY_BASE), col)

    def property_iri(self, col: Column) -> Column:
        return F.concat(F.lit(PROPERTY_BASE), col)

    def node(self, entity_id: str) -> str:
        """IRI of an id given by the user: full IRIs pass, else the prefix decides."""
        kinds = {"iri": "", "entity": ENTITY_BASE, "title": self.title_base, "person": self.person_base}
        return kinds[id_kind(entity_id)] + entity_id

    def named_node_filter(self, col: Column) -> Column:
        """True for titles, people and knowledge-base entities."""
        return any_of(*(iri_startswith(col, base) for base in (self.title_base, self.person_base, ENTITY_BASE)))


# Id prefixes, tried in this order; anything else is a person.
ID_PREFIXES = (("http://", "iri"), ("https://", "iri"), ("Q", "entity"), ("tt", "title"))


def id_kind(entity_id: str) -> str:
    return next((kind for prefix, kind in ID_PREFIXES if entity_id.startswith(prefix)), "person")


def entity_kind(col: Column) -> Column:
    """The same dispatch for a column of ids."""
    return F.coalesce(
        *[F.when(col.startswith(prefix), F.lit(kind)) for prefix, kind in ID_PREFIXES],
        F.lit("person"),
    )


def sanitize_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_-]", "_", name)


def sanitize(col: Column) -> Column:
    return F.regexp_replace(col, "[^A-Za-z0-9_-]", "_")


def last_segment(col: Column) -> Column:
    """Text after the last slash, without surrounding quotes and angle brackets."""
    return F.regexp_replace(F.substring_index(col, "/", -1), r'^["<>]+|["<>]+$', "")


def iri_startswith(col: Column, prefix: str) -> Column:
    return col.startswith(prefix)
