"""Graph queries: neighbours, collaborators, profiles and filmographies.

There are two paths on purpose. The relational one reads warehouse tables; it shows ratings and
falls back to the id where a label is missing. The triples one reads the projected graph; it knows
any entity, follows claim edges and returns named entities only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celluloid.functions.iri import Vocabulary, iri_startswith, last_segment
from celluloid.functions.parse import non_negative, number_text
from celluloid.functions.text import display_name, role_predicate
from celluloid.operators import patterns as gp
from celluloid.operators.relational import not_null, order_collaborators, order_neighbors, other_than, tag
from celluloid.operators.triples import link_rows, owned_claims, project_predicates
from celluloid.schema import ENTITY_BASE, RDF_TYPE
from celluloid.sources.sinks import table_bytes
from celluloid.sources.warehouse import Tables

NEIGHBOR = ("direction", "predicate", "entity_id", "entity_name")


def _edges(df: DataFrame, direction: str, predicate: str | Column, entity: Column, name: Column) -> DataFrame:
    predicate = F.lit(predicate) if isinstance(predicate, str) else predicate
    return df.select(
        F.lit(direction).alias("direction"),
        predicate.alias("predicate"),
        entity.alias("entity_id"),
        name.alias("entity_name"),
    )


def _credit_edges(credits: DataFrame, others: DataFrame, key: str, name: str, direction: str) -> DataFrame:
    """Participant and role edges from one read of the filtered credits."""
    kinds = F.array_compact(F.array(F.lit("participant"), role_predicate(F.col("category"))))
    roles = credits.select(key, F.explode(kinds).alias("predicate")).distinct()
    named = others.select(key, name).join(roles, key)
    return _edges(named, direction, F.col("predicate"), F.col(key), F.col(name))


def _same_as(links: DataFrame, entities: DataFrame) -> DataFrame:
    named = links.join(entities.select("wikidata_id", "label"), "wikidata_id", "left")
    return _edges(named, "out", "sameAs", F.col("wikidata_id"), display_name(F.col("label"), F.col("wikidata_id")))


def title_neighbors(warehouse: Tables, imdb_id: str) -> DataFrame:
    mine = F.col("imdb_id") == imdb_id
    episodes, titles = warehouse.table("episode_edges"), warehouse.table("titles")
    named = titles.select("imdb_id", "primary_title")
    parents = episodes.where(mine).select(F.col("parent_imdb_id").alias("imdb_id"))
    children = warehouse.ordered("episode_edges", "parent_imdb_id").where(F.col("parent_imdb_id") == imdb_id).select("imdb_id")
    rating = warehouse.table("title_ratings").where(mine)
    facts = F.array(
        *[
            F.struct(F.lit(label).alias("predicate"), number_text(F.col(c)).alias("text"))
            for label, c in (("averageRating", "average_rating"), ("voteCount", "num_votes"))
        ]
    )
    values = rating.select(F.explode(facts).alias("f")).select("f.*")
    title = (F.col("imdb_id"), F.col("primary_title"))
    branches = [
        _credit_edges(
            warehouse.table("credits").where(mine), warehouse.table("people"), "imdb_name_id", "primary_name", "out"
        ),
        _edges(named.join(parents, "imdb_id"), "out", "partOfSeries", *title),
        _edges(named.join(children, "imdb_id"), "in", "partOfSeries", *title),
        _same_as(warehouse.table("title_wikidata_links").where(mine), warehouse.table("wikidata_entities")),
        _edges(not_null(values, "text"), "out", F.col("predicate"), F.col("text"), F.col("text")),
    ]
    return order_neighbors(reduce(DataFrame.unionByName, branches).distinct())


def person_neighbors(warehouse: Tables, imdb_name_id: str) -> DataFrame:
    mine = F.col("imdb_name_id") == imdb_name_id
    branches = [
        _credit_edges(
            warehouse.ordered("credits", "imdb_name_id").where(mine), warehouse.table("titles"), "imdb_id", "primary_title", "in"
        ),
        _same_as(warehouse.table("person_wikidata_links").where(mine), warehouse.table("wikidata_entities")),
    ]
    return order_neighbors(reduce(DataFrame.unionByName, branches).distinct())


def neighbors(warehouse: Tables, entity_id: str) -> DataFrame:
    """By id prefix; an id that is neither a title nor a person has no neighbours here."""
    if entity_id.startswith("tt"):
        return title_neighbors(warehouse, entity_id)
    if entity_id.startswith("nm"):
        return person_neighbors(warehouse, entity_id)
    return warehouse.spark.createDataFrame([], ", ".join(f"{c} string" for c in NEIGHBOR))


def shared_titles(pairs: DataFrame, title: str, person: str) -> DataFrame:
    """Number of distinct titles per person, as ``shared_titles``.

    Pairs are made distinct first, which spreads a busy person over many tasks; the count per
    person then combines on the map side.
    """
    counted = pairs.select(title, person).distinct().groupBy(person)
    return counted.agg(non_negative(F.count(F.lit(1))).alias("shared_titles"))


def collaborations(warehouse: Tables, person_id: str) -> DataFrame:
    """People who share titles with a person, and how many."""
    credits = warehouse.table("credits").select("imdb_id", "imdb_name_id")
    own = warehouse.ordered("credits", "imdb_name_id").where(F.col("imdb_name_id") == person_id)
    base = own.select("imdb_id").distinct()
    others = credits.where(other_than(F.col("imdb_name_id"), person_id))
    counts = shared_titles(others.join(base, "imdb_id", "left_semi"), "imdb_id", "imdb_name_id")
    named = counts.join(warehouse.table("people").select("imdb_name_id", "primary_name"), "imdb_name_id")
    return order_collaborators(
        named.select(
            F.col("imdb_name_id").alias("person_id"), F.col("primary_name").alias("person_name"), "shared_titles"
        )
    )


def _names(triples: DataFrame, vocab: Vocabulary, key: str) -> DataFrame:
    return triples.where(F.col("p") == vocab.predicate("name")).select(F.col("s").alias(key), F.col("o").alias("name"))


def neighbors_from_triples(
    triples: DataFrame, entity_id: str, vocab: Vocabulary | None = None, by_object: DataFrame | None = None
) -> DataFrame:
    """Edges from and to any entity whose other end is a named title, person or entity.

    ``by_object`` is the copy of the node edges that is laid out by object, if there is one.
    """
    vocab = vocab or Vocabulary()
    iri = vocab.node(entity_id)
    is_edge = F.col("o_kind") == "iri"
    out = triples.where((F.col("s") == iri) & is_edge & vocab.named_node_filter(F.col("o")))
    inward = (triples if by_object is None else by_object).where((F.col("o") == iri) & is_edge & vocab.named_node_filter(F.col("s")))
    edges = out.select(F.lit("out").alias("direction"), F.col("p"), F.col("o").alias("node")).unionByName(
        inward.select(F.lit("in").alias("direction"), F.col("p"), F.col("s").alias("node"))
    )
    named = _names(triples, vocab, "node").join(edges, "node").orderBy("direction", "p", "name", "node")
    return named.select(
        "direction",
        last_segment(F.col("p")).alias("predicate"),
        last_segment(F.col("node")).alias("entity_id"),
        F.col("name").alias("entity_name"),
    )


def collaborations_from_triples(triples: DataFrame, person_id: str, vocab: Vocabulary | None = None) -> DataFrame:
    vocab = vocab or Vocabulary()
    counts = _shared_in_triples(triples, vocab.node(person_id), vocab)
    people = counts.where(iri_startswith(F.col("other"), vocab.person_base))
    return people.orderBy(F.desc("shared"), "name", "other").select(
        last_segment(F.col("other")).alias("person_id"),
        F.col("name").alias("person_name"),
        F.col("shared").alias("shared_titles"),
    )


def _shared_in_triples(triples: DataFrame, iri: str, vocab: Vocabulary) -> DataFrame:
    """(other, name, shared): titles two participants have in common."""
    cast = triples.where((F.col("p") == vocab.predicate("participant")) & (F.col("o_kind") == "iri")).select(
        F.col("s").alias("title"), F.col("o").alias("other")
    )
    base = cast.where(F.col("other") == iri).select("title").distinct()
    both = cast.where(F.col("other") != iri).join(base, "title", "left_semi")
    counts = shared_titles(both, "title", "other").withColumnRenamed("shared_titles", "shared")
    return counts.join(_names(triples, vocab, "other"), "other")


def recurring_collaborators(triples: DataFrame, person_id: str, vocab: Vocabulary | None = None) -> DataFrame:
    """(other, name, shared_titles), ``other`` as IRI, any kind of participant."""
    vocab = vocab or Vocabulary()
    counts = _shared_in_triples(triples, vocab.node(person_id), vocab)
    return counts.orderBy(F.desc("shared"), "name", "other").select("other", "name", F.col("shared").alias("shared_titles"))


def director_filmography(triples: DataFrame, person_id: str, vocab: Vocabulary | None = None) -> DataFrame:
    """(film, title) of the films a person directed."""
    vocab = vocab or Vocabulary()
    films = gp.match(
        triples,
        [
            ("?film", vocab.predicate("director"), vocab.node(person_id)),
            ("?film", vocab.predicate("name"), "?title"),
        ],
    )
    return gp.select(gp.order_by(films, "title", "film"), "film", "title")


def directed_films(triples: DataFrame, person_id: str, vocab: Vocabulary | None = None) -> DataFrame:
    """(titleId, titleName, year, rating); year and rating may be unbound."""
    vocab = vocab or Vocabulary()
    films = gp.match(
        triples,
        [
            ("?title", vocab.predicate("director"), vocab.node(person_id)),
            ("?title", vocab.predicate("name"), "?titleName"),
        ],
    )
    films = gp.bind(films, "titleId", gp.literal_term(F.regexp_replace(gp.value("title"), "^.*/title/", "")))
    for predicate, name in (("datePublished", "?year"), ("averageRating", "?rating")):
        films = gp.optional(films, triples, [("?title", vocab.predicate(predicate), name)])
    return gp.select(gp.order_by(films, "year", "titleName", "titleId"), "titleId", "titleName", "year", "rating")


# Profiles are long tables (metric, name, value): ``name`` is set for counts per predicate or family.


def _metric(df: DataFrame, metric: str, value: Column) -> DataFrame:
    return df.agg(value.cast("bigint").alias("value")).select(
        F.lit(metric).alias("metric"), F.lit("").alias("name"), "value"
    )


def _counts(df: DataFrame, metric: str, by: Column) -> DataFrame:
    return (
        df.groupBy(by.alias("name"))
        .agg(F.count(F.lit(1)).alias("value"))
        .select(F.lit(metric).alias("metric"), "name", "value")
    )


def triple_count(triples: DataFrame) -> DataFrame:
    """Number of triples as a set."""
    return triples.select("s", "p", "o", "o_kind", "o_type").distinct().agg(F.count(F.lit(1)).alias("total_triples"))


def predicate_counts(triples: DataFrame) -> DataFrame:
    """(predicate, triples), most frequent first."""
    counts = triples.groupBy("p").agg(F.count(F.lit(1)).alias("triples"))
    return counts.orderBy(F.desc("triples"), "p").select(F.col("p").alias("predicate"), "triples")


def count_nodes(triples: DataFrame, type_iri: str | None = None, prefix: str | None = None, vocab=None) -> DataFrame:
    """Distinct nodes of a type, or distinct named nodes whose IRI has a prefix: column ``nodes``."""
    if type_iri is not None:
        rows = triples.where((F.col("p") == RDF_TYPE) & (F.col("o") == type_iri) & (F.col("o_kind") == "iri"))
    else:
        name = (vocab or Vocabulary()).predicate("name")
        rows = triples.where((F.col("p") == name) & F.col("s").startswith(prefix))
    return rows.select("s").distinct().agg(F.count(F.lit(1)).alias("nodes"))


def entity_count(links: DataFrame, claims: DataFrame) -> DataFrame:
    """Distinct entity ids in links and claim values: column ``entities``."""
    ids = links.select("wikidata_id").unionByName(
        claims.where(F.col("value_wikidata_id").isNotNull()).select(F.col("value_wikidata_id").alias("wikidata_id"))
    )
    return ids.distinct().agg(F.count(F.lit(1)).alias("entities"))


# Families whose rows each write exactly one triple of a kind: family -> short predicate.
ROW_MARKS = {"title": "type", "person": "type", "credit": "participant", "episode": "partOfSeries", "link": "sameAs"}


def build_counters(warehouse: Tables, families: DataFrame | None = None, vocab: Vocabulary | None = None) -> DataFrame:
    """Rows read and triples written per family, entities, total and count per predicate.

    One pass over the triples counts them per family and predicate; all triple counters, and the
    row counters of families that write one marked triple per row, are sums over that small result.
    """
    vocab = vocab or Vocabulary()
    families = project_predicates(warehouse, vocab) if families is None else families
    counts = families.groupBy("family", "p").agg(F.count(F.lit(1)).alias("n"))
    no_mark = F.lit(None).cast("string")
    mark = F.coalesce(
        *[F.when((F.col("family") == f) & (F.col("p") == vocab.predicate(p)), F.lit(f)) for f, p in ROW_MARKS.items()],
        no_mark,
    )

    def counter(metric: str, name: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), name.alias("name"))

    kinds = F.array(
        counter("triples_written", F.col("family")),
        counter("predicate", last_segment(F.col("p"))),
        counter("total_triples_written", F.lit("")),
        counter("rows_projected", mark),
    )
    sums = counts.select("n", F.explode(kinds).alias("k")).where(F.col("k.name").isNotNull())
    written = sums.groupBy("k.metric", "k.name").agg(F.sum("n").alias("value"))
    links, claims = link_rows(warehouse), owned_claims(warehouse)
    others = [
        tag(df.agg(F.count(F.lit(1)).alias("value")), metric="rows_projected", name=name)
        for name, df in (("rating", warehouse.table("title_ratings")), ("claim", claims))
    ]
    parts = [written, *others, _metric(entity_count(links, claims), "wikidata_entities", F.first("entities"))]
    return reduce(DataFrame.unionByName, [p.select("metric", "name", "value") for p in parts])


def graph_profile(counters: DataFrame) -> DataFrame:
    """Profile as of build time, from the build counters."""
    # Build counter -> profile metric.
    renamed = {
        ("total_triples_written", ""): "total_triples",
        ("rows_projected", "title"): "title_nodes",
        ("rows_projected", "person"): "person_nodes",
        ("wikidata_entities", ""): "wikidata_entities",
    }
    metric = F.when(F.col("metric") == "predicate", F.col("metric"))
    for (old, name), new in renamed.items():
        metric = metric.when((F.col("metric") == old) & (F.col("name") == name), F.lit(new))
    name = F.when(F.col("metric") == "predicate", F.col("name")).otherwise("")
    rows = counters.select(metric.alias("metric"), name.alias("name"), "value")
    return rows.where(F.col("metric").isNotNull())


def graph_profile_live(triples: DataFrame, vocab: Vocabulary | None = None, with_bytes: bool = False) -> DataFrame:
    """Profile recomputed from the stored set of triples; ``with_bytes`` needs a table read from files."""
    vocab = vocab or Vocabulary()
    parts = [
        _metric(triples, "total_triples", F.count(F.lit(1))),
        _metric(count_nodes(triples, vocab.movie), "title_nodes", F.first("nodes")),
        _metric(count_nodes(triples, vocab.person), "person_nodes", F.first("nodes")),
        _metric(count_nodes(triples, prefix=ENTITY_BASE, vocab=vocab), "wikidata_entities", F.first("nodes")),
        _counts(triples, "predicate", last_segment(F.col("p"))),
    ]
    if with_bytes:
        parts.append(_metric(table_bytes(triples), "store_bytes", F.first("store_bytes")))
    return reduce(DataFrame.unionByName, parts)
