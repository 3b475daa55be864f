"""Stored layouts prune by footer, and graph queries start no job before they are run."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from celluloid.operators import graph, relational, search
from celluloid.sources import sinks
from celluloid.sources.warehouse import Tables, Warehouse, warehouse_stats


@contextmanager
def many_files(spark):
    """As at scale: the output is cut into several files."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        yield
    finally:
        spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def files_that_may_hold(folder, column: str, value) -> tuple[int, int]:
    """(files whose range of the column holds the value, all files)."""
    hits = total = 0
    for path in Path(folder).rglob("*.parquet"):
        footer = pq.ParquetFile(path).metadata
        at = footer.schema.names.index(column)
        ranges = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        total += 1
        hits += any(r.min <= value <= r.max for r in ranges)
    return hits, total


@pytest.fixture(scope="module")
def tables(spark):
    titles = spark.range(3000).selectExpr(
        "format_string('tt%06d', id) as imdb_id", "concat('Film ', id) as primary_title", "cast(null as string) as original_title",
        "'movie' as title_type", "cast(null as string) as genres", "cast(1990 as bigint) as start_year",
    )
    people = spark.range(500).selectExpr("format_string('nm%06d', id) as imdb_name_id", "concat('Person ', id) as primary_name")
    credits = spark.range(9000).selectExpr(
        "format_string('tt%06d', id % 3000) as imdb_id", "format_string('nm%06d', (id * 7) % 500) as imdb_name_id",
        "id as ordering", "'director' as category", "cast(null as string) as job", "cast(null as string) as characters", "'imdb' as source",
    )
    return {"titles": titles, "people": people, "credits": credits}


def test_warehouse_files_have_ranges_of_ids(spark, tables, tmp_path):
    with many_files(spark):
        Warehouse(spark, str(tmp_path)).save("credits", tables["credits"])
    hits, total = files_that_may_hold(tmp_path / "credits", "imdb_id", "tt001234")
    assert total >= 8 and hits <= 2
    hits, total = files_that_may_hold(tmp_path / "credits-by-imdb_name_id", "imdb_name_id", "nm000123")
    assert total >= 8 and hits <= 2
    stored = Warehouse(spark, str(tmp_path))
    assert sorted(map(tuple, stored.ordered("credits", "imdb_name_id").collect())) == sorted(map(tuple, stored.table("credits").collect()))


def test_triple_files_have_ranges_of_subjects(spark, tmp_path):
    triples = spark.range(6000).selectExpr(
        "concat('s', lpad(id % 2000, 5, '0')) as s", "concat('p', id % 2) as p", "cast(id as string) as o", "'iri' as o_kind", "'string' as o_type"
    )
    with many_files(spark):
        sinks.save_triples(triples, str(tmp_path / "t"))
    hits, total = files_that_may_hold(tmp_path / "t" / "p=p1", "s", "s00777")
    assert total >= 4 and hits <= 2
    hits, total = files_that_may_hold(tmp_path / "t-by-object", "o", "777")
    assert total >= 8 and hits <= 2
    assert sinks.load_edges_by_object(spark, str(tmp_path / "t")).count() == 6000


def test_posting_files_have_ranges_of_terms(spark, tables, tmp_path):
    parts = search.title_parts(tables["titles"], tables["credits"], tables["people"])
    with many_files(spark):
        search.SearchIndex.build(parts, tables["titles"].withColumnRenamed("imdb_id", "id")).save(str(tmp_path / "i"))
    hits, total = files_that_may_hold(tmp_path / "i" / "postings", "term", "1234")
    assert total >= 8 and hits <= 2


def jobs_while_building(spark, build) -> int:
    spark.sparkContext.setJobGroup("building", "building")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_graph_queries_start_no_job_while_they_are_built(spark, tables):
    held = Tables(spark, tables)
    triples = spark.createDataFrame([("s", "p", "o", "iri", None)], "s string, p string, o string, o_kind string, o_type string")
    builds = [
        lambda: graph.collaborations(held, "nm000001"),
        lambda: graph.title_neighbors(held, "tt000001"),
        lambda: graph.person_neighbors(held, "nm000001"),
        lambda: graph.directed_films(triples, "nm000001"),
        lambda: graph.director_filmography(triples, "nm000001"),
        lambda: search.title_documents(tables["titles"], tables["credits"], tables["people"]),
    ]
    assert [jobs_while_building(spark, b) for b in builds] == [0] * len(builds)


def test_all_links_of_a_title_are_neighbours(spark, frame):
    links = frame("title_wikidata_links", {"imdb_id": "tt1", "wikidata_id": "Q1"}, {"imdb_id": "tt1", "wikidata_id": "Q2"})
    held = Tables(spark, {"title_wikidata_links": links})
    assert sorted(r["entity_id"] for r in graph.title_neighbors(held, "tt1").collect()) == ["Q1", "Q2"]


def leaf_nodes(df) -> list:
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        children = node.children()
        if not children.size():
            found.append(node)
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_row_counts_come_from_footers(spark, tables, tmp_path):
    stored = Warehouse(spark, str(tmp_path))
    stored.save("people", tables["people"].selectExpr("*", "0L birth_year", "0L death_year", "'' primary_professions", "'' known_for_titles"))
    counts = warehouse_stats(stored, ["people", "titles"])
    assert sorted(map(tuple, counts.collect())) == [("people", 500), ("titles", 0)]
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()


def test_other_ids_have_bloom_filters(spark, tables, tmp_path):
    # a column that has a dictionary in each of its chunks is filtered by that, and gets no other filter
    stored = Warehouse(spark, str(tmp_path))
    many = tables["credits"].limit(1).drop("imdb_name_id").crossJoin(spark.range(60_000).selectExpr("sha2(cast(id as string), 256) as imdb_name_id"))
    stored.save("credits", many)
    jvm = spark.sparkContext._jvm
    path = next(p for p in (tmp_path / "credits").rglob("*.parquet"))
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(str(path)), spark._jsparkSession.sessionState().newHadoopConf())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    known = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
    reader.close()
    assert known["imdb_name_id"] > 0 and known["imdb_id"] < 0


def test_episodes_of_a_series_are_found_in_few_files(spark, tmp_path):
    stored = Warehouse(spark, str(tmp_path))
    titles = spark.range(4000).selectExpr("format_string('tt%06d', id) as imdb_id", "'movie' as title_type", "concat('Film ', id) as primary_title")
    edges = spark.range(4000).selectExpr("format_string('tt%06d', id) as imdb_id", "format_string('tt%06d', (id * 7919) % 400) as parent_imdb_id", "id as season_number", "id as episode_number")
    with many_files(spark):
        stored.save("episode_edges", edges)
        stored.save("titles", titles.selectExpr("*", "cast(null as string) original_title", "0L is_adult", "0L start_year", "0L end_year", "0L runtime_minutes", "cast(null as string) genres"))
    hits, total = files_that_may_hold(tmp_path / "episode_edges-by-parent_imdb_id", "parent_imdb_id", "tt000123")
    assert total >= 8 and hits <= 2
    found = graph.title_neighbors(stored, "tt000123")
    got = sorted(r["entity_id"] for r in found.collect() if r["direction"] == "in")
    assert got == sorted(f"tt{i:06}" for i in range(4000) if i * 7919 % 400 == 123)


def test_a_save_makes_its_rows_once_and_leaves_no_stage(spark, tmp_path):
    counter = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            counter.add(1)
            yield row

    made = spark.createDataFrame(spark.range(200, numPartitions=3).rdd.mapPartitions(seen), "id long")
    Warehouse(spark, str(tmp_path)).save("people", made.selectExpr("cast(id as string) imdb_name_id", *[f"cast(null as {t}) {c}" for c, t in (("primary_name", "string"), ("birth_year", "long"), ("death_year", "long"), ("primary_professions", "string"), ("known_for_titles", "string"))]))
    assert counter.value == 200
    assert not list((tmp_path / "_staging").glob("*"))


def exchanges_over(df, what: str) -> int:
    """Exchanges above the scans of tables whose description has the text."""
    total = 0

    def walk(node, moved: int) -> None:
        nonlocal total
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.initialPlan(), moved)
        children = node.children()
        if not children.size() and what in node.toString():
            total += moved
        for k in range(children.size()):
            walk(children.apply(k), moved + kind.startswith("ShuffleExchange"))

    walk(df._jdf.queryExecution().executedPlan(), 0)
    return total


def test_checked_ids_stay_in_their_buckets(spark, tables, tmp_path):
    stored = Warehouse(spark, str(tmp_path))
    people = tables["people"].selectExpr("*", "0L birth_year", "0L death_year", "'' primary_professions", "'' known_for_titles")
    stored.save("people", people.where("imdb_name_id > 'nm000100'"))
    # as in a session that has not written them
    table = next(t.name for t in spark.catalog.listTables() if t.name == stored._catalogued(f"{tmp_path}/people-keys/v00000001-4"))
    spark.sql(f"DROP TABLE {table}")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = relational.gate(tables["credits"], [(Warehouse(spark, str(tmp_path)).keys("people"), "imdb_name_id", "imdb_name_id")])
        assert kept.count() == tables["credits"].where("imdb_name_id > 'nm000100'").count() > 0
        assert exchanges_over(kept, table) == 0
        plain = relational.gate(tables["credits"], [(stored.table("people"), "imdb_name_id", "imdb_name_id")])
        assert exchanges_over(plain, "FileScan parquet") > 0
        assert sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_batch_rewrites_only_the_folders_of_its_parents(spark, frame, tmp_path):
    stored = Warehouse(spark, str(tmp_path))
    row = lambda movie, key: {"tmdb_movie_id": movie, "credit_key": key, "tmdb_person_id": 1}
    stored.save("tmdb_movie_credits", frame("tmdb_movie_credits", *[row(k, c) for k in range(500) for c in ("a", "b")]))
    files = lambda: {str(p) for p in (tmp_path / "tmdb_movie_credits").rglob("*.parquet")}
    before = files()
    assert len(before) >= 60
    parents = spark.createDataFrame([(7,), (9_999,), (11,)], "tmdb_movie_id long")
    stored.replace("tmdb_movie_credits", parents, frame("tmdb_movie_credits", row(7, "c"), row(9_999, "d")))
    got = sorted((r["tmdb_movie_id"], r["credit_key"]) for r in stored.table("tmdb_movie_credits").collect())
    assert got == sorted([(k, c) for k in range(500) for c in ("a", "b") if k not in (7, 11)] + [(7, "c"), (9_999, "d")])
    assert len(before - files()) <= 3 and len(before & files()) >= len(before) - 3


def test_a_folder_that_is_emptied_goes(spark, frame, tmp_path):
    stored = Warehouse(spark, str(tmp_path))
    stored.save("tmdb_movie_credits", frame("tmdb_movie_credits", {"tmdb_movie_id": 1, "credit_key": "a"}))
    one = spark.createDataFrame([(1,)], "tmdb_movie_id long")
    assert stored.replace("tmdb_movie_credits", one, frame("tmdb_movie_credits")).count() == 0
