"""Projection of the warehouse to triples.

Each family is a scan with an ``explode`` of the triples of one row; only links and claims join.
``family`` keeps the multiset apart by origin; ``as_set`` gives the stored set.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celluloid.functions.iri import Vocabulary
from celluloid.functions.text import role_predicate
from celluloid.schema import RDF_TYPE, ROLES
from celluloid.sources.warehouse import Tables

TRIPLE = ("s", "p", "o", "o_kind", "o_type", "o_num")


@dataclass(frozen=True)
class Fact:
    """One triple a row may give: predicate, object, and the condition it is there."""

    p: str | Column
    o: Column
    there: Column
    kind: str = "iri"
    type: str = ""
    num: Column | None = None
    s: Column | None = None

    def predicate(self) -> Column:
        """The predicate, null where the triple is absent."""
        return F.when(self.there, F.lit(self.p) if isinstance(self.p, str) else self.p)

    def triple(self, subject: Column) -> Column:
        predicate = self.predicate()
        body = F.struct(
            (subject if self.s is None else self.s).alias("s"),
            predicate.alias("p"),
            self.o.alias("o"),
            F.lit(self.kind).alias("o_kind"),
            F.lit(self.type).alias("o_type"),
            (F.lit(None) if self.num is None else self.num).cast("double").alias("o_num"),
        )
        return F.when(predicate.isNotNull(), body)


def double_lexical(col: Column) -> Column:
    """Lexical form of a double literal: whole numbers carry no fraction."""
    return F.regexp_replace(col.cast("string"), r"\.0$", "")


def _text(p: str | Column, o: Column, s: Column | None = None) -> Fact:
    return Fact(p, o, o.isNotNull(), "literal", "string", s=s)


def _integer(p: str, o: Column) -> Fact:
    return Fact(p, o.cast("string"), o.isNotNull(), "literal", "integer", o)


def _double(p: str, o: Column) -> Fact:
    return Fact(p, double_lexical(o), o.isNotNull(), "literal", "double", o)


@dataclass(frozen=True)
class Family:
    """Source rows, their subject and the facts of a row."""

    name: str
    rows: DataFrame
    subject: Column
    facts: list[Fact]

    def triples(self) -> DataFrame:
        listed = F.array_compact(F.array(*[f.triple(self.subject) for f in self.facts]))
        exploded = self.rows.select(F.explode(listed).alias("t"))
        return exploded.select(F.lit(self.name).alias("family"), *[F.col(f"t.{c}").alias(c) for c in TRIPLE])

    def predicates(self) -> DataFrame:
        """One row per triple with its predicate only; subjects and objects are not built."""
        listed = F.array_compact(F.array(*[f.predicate() for f in self.facts]))
        return self.rows.select(F.lit(self.name).alias("family"), F.explode(listed).alias("p"))


def title_family(titles: DataFrame, vocab: Vocabulary) -> Family:
    """Every title is a Movie, episodes included."""
    return Family(
        "title",
        titles,
        vocab.title_iri(F.col("imdb_id")),
        [
            Fact(RDF_TYPE, F.lit(vocab.movie), F.lit(True)),
            _text(vocab.predicate("name"), F.col("primary_title")),
            _text(vocab.predicate("titleType"), F.col("title_type")),
            _integer(vocab.predicate("datePublished"), F.col("start_year")),
            _text(vocab.predicate("originalTitle"), F.col("original_title")),
        ],
    )


def person_family(people: DataFrame, vocab: Vocabulary) -> Family:
    return Family(
        "person",
        people,
        vocab.person_iri(F.col("imdb_name_id")),
        [
            Fact(RDF_TYPE, F.lit(vocab.person), F.lit(True)),
            _text(vocab.predicate("name"), F.col("primary_name")),
            _integer(vocab.predicate("birthYear"), F.col("birth_year")),
            _integer(vocab.predicate("deathYear"), F.col("death_year")),
        ],
    )


def credit_family(credits: DataFrame, vocab: Vocabulary) -> Family:
    """Everyone credited is a participant; some categories also give a role."""
    iris = [F.lit(x) for role in sorted(set(ROLES.values())) for x in (role, vocab.predicate(role))]
    role = role_predicate(F.col("category"))
    person = vocab.person_iri(F.col("imdb_name_id"))
    return Family(
        "credit",
        credits,
        vocab.title_iri(F.col("imdb_id")),
        [
            Fact(vocab.predicate("participant"), person, F.lit(True)),
            Fact(F.try_element_at(F.create_map(*iris), role), person, role.isNotNull()),
        ],
    )


def episode_family(episodes: DataFrame, vocab: Vocabulary) -> Family:
    parent = vocab.title_iri(F.col("parent_imdb_id"))
    return Family(
        "episode",
        episodes,
        vocab.title_iri(F.col("imdb_id")),
        [
            Fact(vocab.predicate("partOfSeries"), parent, F.lit(True)),
            _integer(vocab.predicate("seasonNumber"), F.col("season_number")),
            _integer(vocab.predicate("episodeNumber"), F.col("episode_number")),
        ],
    )


def rating_family(ratings: DataFrame, vocab: Vocabulary) -> Family:
    return Family(
        "rating",
        ratings,
        vocab.title_iri(F.col("imdb_id")),
        [
            _double(vocab.predicate("averageRating"), F.col("average_rating")),
            _integer(vocab.predicate("voteCount"), F.col("num_votes")),
        ],
    )


def link_rows(warehouse: Tables) -> DataFrame:
    """Links whose local record and entity both exist: (kind, local_id, wikidata_id, label, description)."""
    entities = warehouse.table("wikidata_entities")
    parts = []
    for kind, links, locals_, key in (
        ("title", "title_wikidata_links", "titles", "imdb_id"),
        ("person", "person_wikidata_links", "people", "imdb_name_id"),
    ):
        # links are unique on both sides, so neither join has a hot key
        known = warehouse.table(links).join(warehouse.table(locals_).select(key), key, "left_semi")
        joined = known.join(entities, "wikidata_id", "inner")
        parts.append(
            joined.select(
                F.lit(kind).alias("entity_kind"),
                F.col(key).alias("local_id"),
                "wikidata_id",
                "label",
                "description",
            )
        )
    return parts[0].unionByName(parts[1])


def owned_claims(warehouse: Tables) -> DataFrame:
    """Claims of linked entities, once per link."""
    claims = warehouse.table("wikidata_claims").select(
        "subject_wikidata_id", "property_id", "ordinal", "value_type", "value_text", "value_wikidata_id"
    )
    links = None
    for kind, name, key in (
        ("title", "title_wikidata_links", "imdb_id"),
        ("person", "person_wikidata_links", "imdb_name_id"),
    ):
        part = warehouse.table(name).select(
            F.lit(kind).alias("entity_kind"),
            F.col(key).alias("local_id"),
            F.col("wikidata_id").alias("subject_wikidata_id"),
        )
        links = part if links is None else links.unionByName(part)
    return claims.join(links, "subject_wikidata_id")


def claim_rows(warehouse: Tables) -> DataFrame:
    """Claims of linked entities with the label of an entity value."""
    owned = owned_claims(warehouse)
    labels = warehouse.table("wikidata_entities").select(
        F.col("wikidata_id").alias("value_wikidata_id"), F.col("label").alias("value_wikidata_label")
    )
    # a common value, such as one language, may be that of a third of all claims
    return owned.join(labels, "value_wikidata_id", "left")


def _local_iri(vocab: Vocabulary) -> Column:
    local = F.col("local_id")
    return F.when(F.col("entity_kind") == "title", vocab.title_iri(local)).otherwise(vocab.person_iri(local))


def link_family(links: DataFrame, vocab: Vocabulary) -> Family:
    entity = vocab.entity_iri(F.col("wikidata_id"))
    return Family(
        "link",
        links,
        _local_iri(vocab),
        [
            Fact(vocab.predicate("sameAs"), entity, F.lit(True)),
            _text(vocab.predicate("name"), F.col("label"), s=entity),
            _text(vocab.predicate("description"), F.col("description"), s=entity),
        ],
    )


def claim_family(claims: DataFrame, vocab: Vocabulary) -> Family:
    """An entity value gives an edge and, if labelled, the entity's name; else the text is used."""
    prop = vocab.property_iri(F.col("property_id"))
    entity = vocab.entity_iri(F.col("value_wikidata_id"))
    is_entity = F.col("value_wikidata_id").isNotNull()
    text, label = F.col("value_text"), F.col("value_wikidata_label")
    return Family(
        "claim",
        claims,
        _local_iri(vocab),
        [
            Fact(vocab.predicate("name"), label, is_entity & label.isNotNull(), "literal", "string", s=entity),
            Fact(prop, entity, is_entity),
            Fact(prop, text, ~is_entity & text.isNotNull(), "literal", "string"),
        ],
    )


def graph_families(warehouse: Tables, vocab: Vocabulary | None = None) -> list[Family]:
    vocab = vocab or Vocabulary()
    return [
        title_family(warehouse.table("titles"), vocab),
        person_family(warehouse.table("people"), vocab),
        credit_family(warehouse.table("credits"), vocab),
        episode_family(warehouse.table("episode_edges"), vocab),
        rating_family(warehouse.table("title_ratings"), vocab),
        link_family(link_rows(warehouse), vocab),
        claim_family(claim_rows(warehouse), vocab),
    ]


def project_families(warehouse: Tables, vocab: Vocabulary | None = None) -> DataFrame:
    """All triples as written, repeats included, with their family."""
    return reduce(DataFrame.unionByName, [f.triples() for f in graph_families(warehouse, vocab)])


def project_predicates(warehouse: Tables, vocab: Vocabulary | None = None) -> DataFrame:
    """(family, p) of all triples as written: all that counting them needs."""
    return reduce(DataFrame.unionByName, [f.predicates() for f in graph_families(warehouse, vocab)])


def as_set(triples: DataFrame) -> DataFrame:
    """The triples as a set; repeats collapse before the shuffle."""
    keys = [c for c in TRIPLE if c != "o_num"]
    # o_num follows from o and o_type
    return triples.groupBy(*keys).agg(F.first("o_num").alias("o_num")).select(*TRIPLE)


def as_set_cut(triples: DataFrame) -> DataFrame:
    """The triples as a set, cut by range of (p, s, o) and sorted by these, as they are stored: equal ones meet in the
    only exchange, and the first of them stays."""
    keys = ["p", "s", "o", "o_kind", "o_type"]
    cut = triples.select(*TRIPLE).repartitionByRange("p", "s", "o")
    nth = cut.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy("o_num")))
    return nth.where("_nth = 1").select(*TRIPLE)


def project_graph(warehouse: Tables, vocab: Vocabulary | None = None, cut: bool = False) -> DataFrame:
    """The set of all triples; with ``cut``, where their table wants them."""
    if not cut:
        return as_set(project_families(warehouse, vocab))
    # a value that many claims have is named by each of them: its repeats collapse before they are moved
    parts = [f.triples().select(*TRIPLE) for f in graph_families(warehouse, vocab)]
    return as_set_cut(reduce(DataFrame.unionByName, [*parts[:-1], as_set(parts[-1])]))
