"""The small film graph with worked-out results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from celluloid import Tables
from celluloid.functions.iri import Vocabulary
from celluloid.operators import graph, triples
from celluloid.operators import patterns as gp
from celluloid.sources import sinks
from conftest import rows_of

VOCAB = Vocabulary()


@pytest.fixture(scope="module")
def tables(spark, frame):
    def title(i, kind, name, original, year):
        return {
            "imdb_id": i,
            "title_type": kind,
            "primary_title": name,
            "original_title": original,
            "is_adult": 0,
            "start_year": year,
            "genres": "Drama",
        }

    def credit(t, p, o, c):
        return {"imdb_id": t, "imdb_name_id": p, "ordering": o, "category": c, "source": "imdb"}

    def claim(s, p, kind, text=None, entity=None):
        return {
            "subject_wikidata_id": s,
            "property_id": p,
            "value_type": kind,
            "value_text": text,
            "value_wikidata_id": entity,
            "ordinal": 0,
        }

    frames = {
        "titles": frame(
            "titles",
            title("tt1", "movie", "Quiet Harbour", "Det store harbour", 1954),
            title("tt2", "movie", "Lantern", "Lantern", 1952),
            title("tt3", "tvEpisode", "A Bold Episode", "A Bold Episode", 1955),
        ),
        "people": frame(
            "people",
            {"imdb_name_id": "nm1", "primary_name": "Mira Oslund", "birth_year": 1910},
            {"imdb_name_id": "nm2", "primary_name": "Tomas Veld", "birth_year": 1905},
        ),
        "credits": frame(
            "credits",
            credit("tt1", "nm1", 1, "director"),
            credit("tt1", "nm2", 2, "actor"),
            credit("tt2", "nm1", 1, "director"),
            credit("tt2", "nm2", 2, "actor"),
            credit("tt3", "nm1", 1, "writer"),
        ),
        "episode_edges": frame(
            "episode_edges", {"imdb_id": "tt3", "parent_imdb_id": "tt1", "season_number": 1, "episode_number": 3}
        ),
        "title_ratings": frame("title_ratings", {"imdb_id": "tt1", "average_rating": 8.6, "num_votes": 1000}),
        "wikidata_entities": frame(
            "wikidata_entities",
            {"wikidata_id": "Q2000", "label": "Quiet Harbour", "description": "film"},
            {"wikidata_id": "Q1000", "label": "Mira Oslund", "description": "director"},
            {"wikidata_id": "Q2001", "label": "sea drama", "description": "genre"},
        ),
        "title_wikidata_links": frame("title_wikidata_links", {"imdb_id": "tt1", "wikidata_id": "Q2000"}),
        "person_wikidata_links": frame("person_wikidata_links", {"imdb_name_id": "nm1", "wikidata_id": "Q1000"}),
        "wikidata_claims": frame(
            "wikidata_claims",
            claim("Q2000", "P136", "wikidata_item", entity="Q2001"),
            claim("Q2000", "P577", "time", text="+2003-09-12T00:00:00Z"),
            claim("Q1000", "P569", "time", text="+1971-03-23T00:00:00Z"),
        ),
    }
    return Tables(spark, frames)


@pytest.fixture(scope="module")
def stored(tables, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("graph") / "triples")
    sinks.save_triples(triples.project_graph(tables, VOCAB), path)
    return sinks.load_triples(spark, path)


def test_counters(tables):
    got = {(r["metric"], r["name"]): r["value"] for r in graph.build_counters(tables, vocab=VOCAB).collect()}
    rows = {"title": 3, "person": 2, "credit": 5, "episode": 1, "rating": 1, "link": 2, "claim": 3}
    assert {k[1]: v for k, v in got.items() if k[0] == "rows_projected"} == rows
    assert got["total_triples_written", ""] == 46
    assert got["wikidata_entities", ""] == 3
    assert {k[1]: v for k, v in got.items() if k[0] == "predicate"} == {
        "22-rdf-syntax-ns#type": 5,
        "name": 8,
        "titleType": 3,
        "datePublished": 3,
        "originalTitle": 3,
        "birthYear": 2,
        "participant": 5,
        "director": 2,
        "actor": 2,
        "writer": 1,
        "partOfSeries": 1,
        "seasonNumber": 1,
        "episodeNumber": 1,
        "averageRating": 1,
        "voteCount": 1,
        "sameAs": 2,
        "description": 2,
        "P136": 1,
        "P577": 1,
        "P569": 1,
    }


def test_profiles_agree_without_repeats(tables, stored, spark, tmp_path):
    built = graph.graph_profile(graph.build_counters(tables, vocab=VOCAB))
    live = graph.graph_profile_live(stored, VOCAB, with_bytes=True)
    path = str(tmp_path / "profile")
    sinks.save_profile(live, path)
    back = {(r["metric"], r["name"]): r["value"] for r in sinks.load_profile(spark, path).collect()}
    assert back.pop(("store_bytes", "")) > 0
    assert back == {(r["metric"], r["name"]): r["value"] for r in built.collect()}
    assert back["title_nodes", ""] == 3
    assert back["person_nodes", ""] == 2
    assert back["total_triples", ""] == 46


def test_title_neighbors(tables):
    assert rows_of(graph.neighbors(tables, "tt1"), "direction", "predicate", "entity_id") == [
        ("in", "partOfSeries", "tt3"),
        ("out", "actor", "nm2"),
        ("out", "averageRating", "8.6"),
        ("out", "director", "nm1"),
        ("out", "participant", "nm1"),
        ("out", "participant", "nm2"),
        ("out", "sameAs", "Q2000"),
        ("out", "voteCount", "1000"),
    ]
    assert rows_of(graph.neighbors(tables, "tt3"), "direction", "predicate", "entity_id") == [
        ("out", "partOfSeries", "tt1"),
        ("out", "participant", "nm1"),
        ("out", "writer", "nm1"),
    ]


def test_person_neighbors(tables):
    got = rows_of(graph.neighbors(tables, "nm1"), "direction", "predicate", "entity_id")
    assert {r[2] for r in got} == {"tt1", "tt2", "tt3", "Q1000"}
    assert ("out", "sameAs", "Q1000") in got


def test_unknown_kind_has_no_neighbors(tables):
    assert graph.neighbors(tables, "Q2000").count() == 0


def test_both_paths_agree_on_shared_edges(tables, stored):
    shared = {"participant", "director", "actor", "writer", "producer", "partOfSeries", "sameAs"}
    for entity in ("tt1", "tt3", "nm1", "nm2"):
        relational = {r for r in rows_of(graph.neighbors(tables, entity)) if r[1] in shared}
        graphed = {r for r in rows_of(graph.neighbors_from_triples(stored, entity, VOCAB)) if r[1] in shared}
        assert relational == graphed


def test_neighbors_of_entities_and_iris(stored):
    assert rows_of(graph.neighbors_from_triples(stored, "Q2001", VOCAB)) == [("in", "P136", "tt1", "Quiet Harbour")]
    by_iri = graph.neighbors_from_triples(stored, VOCAB.node("tt2"), VOCAB)
    assert rows_of(by_iri) == rows_of(graph.neighbors_from_triples(stored, "tt2", VOCAB))


def test_collaborators_on_both_paths(tables, stored):
    expected = [("nm2", "Tomas Veld", 2)]
    assert rows_of(graph.collaborations(tables, "nm1")) == expected
    assert rows_of(graph.collaborations_from_triples(stored, "nm1", VOCAB)) == expected
    assert rows_of(graph.recurring_collaborators(stored, "nm1", VOCAB)) == [
        (VOCAB.node("nm2"), "Tomas Veld", 2)
    ]


def test_filmographies(stored):
    assert rows_of(graph.director_filmography(stored, "nm1", VOCAB)) == [
        (VOCAB.node("tt2"), "Lantern"),
        (VOCAB.node("tt1"), "Quiet Harbour"),
    ]
    assert rows_of(graph.directed_films(stored, "nm1", VOCAB)) == [
        ("tt2", "Lantern", "1952", None),
        ("tt1", "Quiet Harbour", "1954", "8.6"),
    ]


def test_order_puts_unbound_first_and_numbers_by_value(spark):
    rows = spark.createDataFrame(
        [("a", None), ("b", ("literal", "10", "integer")), ("c", ("literal", "9", "integer")), ("d", ("literal", "9.5", "double"))],
        "n string, x struct<kind: string, value: string, type: string>",
    )
    assert [r["n"] for r in gp.order_by(rows, "x").collect()] == ["a", "c", "d", "b"]
    assert [r["n"] for r in gp.order_by(rows, "-x").collect()] == ["b", "d", "c", "a"]


def test_literals_repeated_variables_and_forms(stored):
    named = gp.match(stored, [("?x", VOCAB.predicate("name"), gp.Literal("Lantern"))])
    assert rows_of(gp.select(named, "x")) == [(VOCAB.node("tt2"),)]
    assert gp.ask(named)
    assert not gp.ask(gp.match(stored, [("?x", VOCAB.predicate("name"), "?x")]))
    assert rows_of(gp.ask_frame(gp.match(stored, [("?x", VOCAB.predicate("name"), "?x")]))) == [(False,)]
    made = gp.construct(named, [("?x", "https://p/q", gp.Literal("seen"))])
    assert rows_of(made) == [(VOCAB.node("tt2"), "https://p/q", "seen")]
    assert gp.describe(stored, VOCAB.node("tt3")).count() == 10
    with pytest.raises(ValueError, match="share a variable"):
        gp.match(stored, [("?x", VOCAB.type, VOCAB.movie), ("?y", VOCAB.type, VOCAB.person)])


def test_union_keeps_missing_variables_unbound(stored):
    a = gp.match(stored, [("?x", VOCAB.predicate("seasonNumber"), "?n")])
    b = gp.match(stored, [("?x", VOCAB.predicate("deathYear"), "?y")])
    c = gp.match(stored, [("?x", VOCAB.predicate("voteCount"), "?v")])
    assert sorted(rows_of(gp.select(gp.union(a, b, c), "x", "n", "v")), key=str) == sorted(
        [(VOCAB.node("tt3"), "1", None), (VOCAB.node("tt1"), None, "1000")], key=str
    )


def test_nquads_escape_literals(spark):
    rows = [
        ("https://a/s", "https://a/p", 'say "hi"\\\n', "literal", "string", None),
        ("https://a/s", "https://a/p", "8", "literal", "double", 8.0),
        ("https://a/s", "https://a/p", "https://a/o", "iri", "", None),
    ]
    df = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_type string, o_num double")
    assert [r[0] for r in rows_of(sinks.nquads_lines(df))] == [
        '<https://a/s> <https://a/p> "say \\"hi\\"\\\\\\n" .',
        '<https://a/s> <https://a/p> "8"^^<http://www.w3.org/2001/XMLSchema#double> .',
        "<https://a/s> <https://a/p> <https://a/o> .",
    ]


def test_whole_doubles_have_no_fraction(spark):
    df = spark.createDataFrame([(8.0,), (8.6,), (10.0,)], "d double")
    assert rows_of(df.select(triples.double_lexical(F.col("d")))) == [("8",), ("8.6",), ("10",)]


def test_nquads_and_json_sinks(stored, spark, tmp_path):
    path = str(tmp_path / "nq")
    sinks.write_nquads(stored, path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert len(lines) == 46
    assert f'<{VOCAB.node("tt1")}> <{VOCAB.predicate("averageRating")}> "8.6"^^<http://www.w3.org/2001/XMLSchema#double> .' in lines
    rows = spark.createDataFrame([("a", None, 1)], "x string, y string, n int")
    assert rows_of(sinks.to_json_rows(rows)) == [('{"x":"a","n":1}',)]
