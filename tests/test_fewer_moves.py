"""What is stored is shuffled once and in few rows, and no table of ids passes through the driver."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from celluloid.adapters import films
from celluloid.functions.iri import Vocabulary
from celluloid.operators import mutations as m
from celluloid.operators import search, triples
from celluloid.plans import entities
from celluloid.session import own_scratch
from celluloid.sources import sinks
from celluloid.sources.warehouse import Tables, Warehouse
from conftest import rows_of
from test_layout import exchanges_over, many_files

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield
    spark.conf.set(THRESHOLD, before)


def bag(df, *columns) -> Counter:
    return Counter(rows_of(df, *columns))


def test_rows_with_several_order_columns_are_upserted_where_they_are_stored(spark):
    some = random.Random(4)
    pick = lambda *of: some.choice(of)
    rows = [(pick("a", "b", None), pick(1, 2, None), pick(None, 1, 2, 3), i, f"v{i}") for i in range(300)]
    incoming = spark.createDataFrame(rows, "k string, j long, a1 long, a2 long, v string")
    stored = spark.createDataFrame([("a", 1, "old"), ("c", 1, "old"), ("a", None, "old")], "k string, j long, v string")
    for existing in (None, stored):
        args = (existing, incoming, ["k", "j"], ["a1", "a2"], ("j",))
        got = m.upsert(*args, cut=True)
        assert bag(got, "k", "j", "v") == bag(m.upsert(*args), "k", "j", "v")
        assert exchanges_over(got, "Scan") <= 2  # one for each side
    same = spark.createDataFrame([("a", 1, 5, 5, "x")] * 3 + [("a", None, 5, 5, "x")] * 2, incoming.schema)
    assert bag(m.upsert(None, same, ["k", "j"], ["a1", "a2"], ("j",), cut=True), "k", "j", "v") == {("a", 1, "x"): 1, ("a", None, "x"): 2}


def test_stored_credits_are_the_landed_ones_moved_once(spark, tmp_path):
    own_scratch(spark)
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate string, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    some = random.Random(5)
    pick = lambda *of: some.choice(of)
    rows = [
        (pick(None, 97, 6, 12, 18, 7), pick(None, 1, 2), pick(1, 2), pick(1, 2, None), pick(None, 1.0, 2.0), pick("1997-01-01", None), 1.0, 0.0, 0.0, pick("N", "A", None), pick("O", None))
        for _ in range(400)
    ]
    spark.createDataFrame(rows + rows[:50], columns).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got, landed = films.credits(spark, str(tmp_path), cut=True), films.credits(spark, str(tmp_path))
    names = sorted(landed.columns)
    assert sorted(got.columns) == names and bag(got, *names) == bag(landed, *names)
    assert exchanges_over(got, "FileScan parquet") == 1
    stored = Warehouse(spark, str(tmp_path / "w")).save("credits", got, cut=True)
    assert bag(stored, *names) == bag(landed, *names)


@pytest.fixture(scope="module")
def crowd(spark):
    """400 titles with nine credited names each, made of few words; credits are repeated, some of unknown titles."""
    titles = spark.range(400).selectExpr(
        "format_string('tt%06d', id) as imdb_id", "'movie' as title_type", "concat('Film ', id) as primary_title", "cast(null as string) as original_title", "'drama' as genres"
    )
    people = spark.range(60).selectExpr("format_string('nm%06d', id) as imdb_name_id", "concat('Player name ', id % 20) as primary_name", "'actor' as primary_professions")
    credits = spark.range(8000).selectExpr("format_string('tt%06d', id % 420) as imdb_id", "format_string('nm%06d', (id * 7) % 60) as imdb_name_id")
    return titles, people, credits


def test_counted_frequencies_of_a_task_are_a_row_for_each_term(spark, crowd, tmp_path, monkeypatch):
    titles, people, credits = crowd
    documents = titles.withColumnRenamed("imdb_id", "id")
    built = search.SearchIndex.build(search.title_parts(titles, credits, people), documents)
    counted = built.postings.where("field = 'context'").count()
    order = ("term", "field", "id", "tf", "len")
    wanted = bag(built.postings, *order)
    for number, rows in enumerate((search.COUNTED_ROWS, 100)):
        monkeypatch.setattr(search, "COUNTED_ROWS", rows)
        stored = built.save(str(tmp_path / str(number)))
        lists = spark.read.parquet(str(tmp_path / str(number) / "postings")).where("counts and not placed")
        assert lists.count() < counted / 4  # each was a row of its own
        assert bag(stored.postings, *order) == wanted
        assert bag(stored.term_stats(), "field", "term", "doc_freq") == bag(built.term_stats(), "field", "term", "doc_freq")
        assert bag(stored.positions, "term", "id", "field", "part", "pos") == bag(built.positions, "term", "id", "field", "part", "pos")
        assert rows_of(stored.field_totals().orderBy("field")) == rows_of(built.field_totals().orderBy("field"))


def test_credits_move_to_their_title_once(spark, crowd, tmp_path, no_broadcast):
    titles, people, credits = crowd
    credits.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert exchanges_over(search.title_parts(titles, stored, people), str(tmp_path)[:20]) <= 3  # four before
    assert exchanges_over(search.person_parts(people, stored, titles), str(tmp_path)[:20]) <= 3
    parts = search.title_parts(titles, stored, people).where("part <> ''")
    brute = {(c["imdb_id"], p["primary_name"]) for c in credits.collect() for p in people.collect() if c["imdb_name_id"] == p["imdb_name_id"] and c["imdb_id"] < "tt000400"}
    assert bag(parts, "id", "text") == Counter(brute)


def test_triples_are_cut_and_made_a_set_in_one_move(spark, frame, tmp_path, no_broadcast):
    vocab = Vocabulary()
    credit = lambda k, n: {"imdb_id": f"tt{k:04}", "imdb_name_id": f"nm{k % 7}", "ordering": n, "category": "director", "source": "imdb"}
    Warehouse(spark, str(tmp_path / "w")).save("credits", frame("credits", *[credit(k, n) for k in range(900) for n in (1, 2)]))
    held = {
        "titles": frame("titles", *[{"imdb_id": f"tt{k:04}", "primary_title": f"n{k % 5}"} for k in range(900)]),
        "credits": Warehouse(spark, str(tmp_path / "w")).table("credits"),
        "wikidata_entities": frame("wikidata_entities", *[{"wikidata_id": f"Q{k}", "label": f"l{k}"} for k in range(30)]),
        "title_wikidata_links": frame("title_wikidata_links", *[{"imdb_id": f"tt{k:04}", "wikidata_id": f"Q{k}"} for k in range(20)]),
        "wikidata_claims": frame("wikidata_claims", *[{"subject_wikidata_id": f"Q{k}", "property_id": "P136", "value_wikidata_id": "Q29", "ordinal": n} for k in range(20) for n in (0, 1)]),
    }
    tables = Tables(spark, held)
    wanted = bag(triples.project_graph(tables, vocab), *triples.TRIPLE)
    with many_files(spark):
        cut = triples.project_graph(tables, vocab, cut=True)
        assert exchanges_over(cut, "FileScan parquet") == 1
        sinks.save_triples(cut, str(tmp_path / "t"), cut=True)
    assert bag(sinks.load_triples(spark, str(tmp_path / "t")), *triples.TRIPLE) == wanted and max(wanted.values()) == 1
    edges = Counter({row: n for row, n in wanted.items() if row[3] == "iri"})
    assert bag(sinks.load_edges_by_object(spark, str(tmp_path / "t")), *triples.TRIPLE) == edges


def test_ids_in_small_files_are_not_sent_through_the_driver(spark, tmp_path):
    """By the size of their files all of these tables would be broadcast."""
    for name, prefix, key in (("titles", "tt", "imdb_id"), ("people", "nm", "imdb_name_id")):
        spark.range(500).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias(key)).write.parquet(str(tmp_path / name))
    tables = Tables(spark, {n: spark.read.parquet(str(tmp_path / n)) for n in ("titles", "people")})
    statement = '{"mainsnak":{"datavalue":{"value":"@"}}}'
    lines = spark.range(300).select(
        F.concat(F.lit("Q"), "id").alias("wikidata_id"), F.lit("l").alias("label"), F.lit("d").alias("description"),
        F.create_map(F.lit("P345"), F.array(F.parse_json(F.replace(F.lit(statement), F.lit("@"), F.concat(F.lit("tt"), F.col("id") * 2))))).alias("claims"),
        F.lit("f").alias("_file"), F.lit(0).cast("long").alias("_block"), F.col("id").alias("_line"),
    )
    lines.write.parquet(str(tmp_path / "items"))
    made = entities.entity_tables(spark.read.parquet(str(tmp_path / "items")), tables)
    assert made["wikidata_entities"].count() == 300 and made["title_wikidata_links"].count() == 250
    for name in ("wikidata_entities", "title_wikidata_links", "wikidata_claims"):
        rows = made[name]
        rows.collect()
        assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
