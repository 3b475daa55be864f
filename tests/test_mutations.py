from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from celluloid.operators import mutations as m
from celluloid.operators.relational import explode_ids, gate
from conftest import rows_of

SCHEMA = "k string, n bigint, a string, b string, at bigint"
NULLABLE = "k string, n bigint, a string, b string"


@pytest.fixture
def batches(spark):
    rng = random.Random(7)

    def row(at):
        return (
            "hot" if rng.random() < 0.4 else f"k{rng.randrange(5)}",
            rng.choice([1, 2, None]),
            rng.choice(["x", "y", None]),
            rng.choice(["p", "q", None]),
            at,
        )

    rows = [row(i) for i in range(300)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    old = {}
    for k, n, a, b, _ in [row(0) for _ in range(60)]:
        if n is not None:
            old[(k, n)] = (a, b)
    existing = [(k, n, *v) for (k, n), v in old.items()] + [("hot", None, "old", None)]
    return (
        spark.createDataFrame(existing, NULLABLE),
        spark.createDataFrame(shuffled, SCHEMA),
        existing,
        rows,
    )


def replay(existing, rows, on_conflict):
    """Statement by statement, as a keyed table would do it; a null in the key never conflicts."""
    table, free = {}, []
    for k, n, a, b in existing:
        if n is None:
            free.append((k, n, a, b))
        else:
            table[(k, n)] = (a, b)
    for k, n, a, b, _ in rows:
        if n is None:
            free.append((k, n, a, b))
        elif (k, n) in table:
            table[(k, n)] = on_conflict(table[(k, n)], (a, b))
        else:
            table[(k, n)] = (a, b)
    return sorted([(k, n, *v) for (k, n), v in table.items()] + free, key=str)


@pytest.mark.parametrize(
    ("func", "on_conflict", "extra"),
    [
        (m.upsert, lambda old, new: new, ()),
        (m.insert_ignore, lambda old, new: old, ()),
        (m.upsert_columns, lambda old, new: (old[0], new[1]), (["b"],)),
    ],
)
def test_keyed_writes_match_statement_replay(batches, func, on_conflict, extra):
    existing, incoming, old_rows, new_rows = batches
    got = func(existing, incoming, ["k", "n"], ["at"], *extra, nullable=["n"])
    assert sorted(rows_of(got.select("k", "n", "a", "b")), key=str) == replay(old_rows, new_rows, on_conflict)


def test_merge_keeps_the_last_value_that_is_not_null(batches):
    existing, incoming, old_rows, new_rows = batches
    table = {}
    for k, n, a, b, *_ in [*[r for r in old_rows if r[1] is not None], *[r for r in new_rows if r[1] is not None]]:
        old = table.get((k, n), (None, None))
        table[(k, n)] = (a if a is not None else old[0], b if b is not None else old[1])
    keep = F.col("n").isNotNull()
    got = m.merge_non_null(existing.where(keep), incoming.where(keep), ["k", "n"], ["at"])
    assert sorted(rows_of(got.select("k", "n", "a", "b")), key=str) == sorted(
        [(*key, *v) for key, v in table.items()], key=str
    )


def test_replace_children_also_clears_parents_without_rows(spark):
    old = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "a", "x"), (3, "a", "x")], "p int, k string, v string")
    new = spark.createDataFrame([(1, "a", "y", 1), (1, "a", "z", 2)], "p int, k string, v string, at int")
    parents = spark.createDataFrame([(1,), (3,)], "p int")
    got = m.replace_children(old, new, parents, "p", ["p", "k"], ["at"])
    assert sorted(rows_of(got)) == [(1, "a", "z"), (2, "a", "x")]


def test_links_last_remote_per_local_then_first_local_per_remote(spark):
    said = [("t1", "Q1", 1), ("t2", "Q1", 2), ("t1", "Q2", 3), ("t3", "Q3", 4), ("t4", "Q3", 5)]
    links, rejects = m.upsert_links(None, spark.createDataFrame(said, "l string, r string, at int"), "l", "r", ["at"])
    assert sorted(rows_of(links)) == [("t1", "Q2"), ("t2", "Q1"), ("t3", "Q3")]
    assert sorted(rows_of(rejects)) == [("t4", "Q3")]


def test_moved_links_match_statement_replay(spark):
    """Statements that a table with both ids unique accepts one by one, over several batches."""
    rng = random.Random(11)
    table, existing = {}, None
    moved = [[("L1", "R1"), ("L1", "R2"), ("L2", "R1")]]
    for batch in [*moved, *([] for _ in range(4))]:
        while len(batch) < 40:
            batch.append((f"L{rng.randint(1, 12)}", f"R{rng.randint(1, 15)}"))
        accepted = []
        for local, remote in batch:
            if remote not in table.values() or table.get(local) == remote:
                table[local] = remote
                accepted.append((local, remote, len(accepted)))
        links, rejects = m.upsert_links(existing, spark.createDataFrame(accepted, "l string, r string, at int"), "l", "r", ["at"])
        assert rejects.count() == 0 and dict(rows_of(links, "l", "r")) == table
        existing = spark.createDataFrame(sorted(table.items()), "l string, r string")


def test_outcome_updates_the_queue(spark, frame):
    queue = frame(
        "tmdb_movie_exports",
        {"export_artifact_id": 1, "tmdb_movie_id": 1, "hydrate_attempts": 0},
        {"export_artifact_id": 1, "tmdb_movie_id": 2, "hydrate_attempts": 2, "last_error": "old"},
        {"export_artifact_id": 1, "tmdb_movie_id": 3, "hydrate_attempts": 1, "last_error": "kept"},
    )
    outcome = spark.createDataFrame(
        [(1, 1, "boom"), (1, 2, None)], "export_artifact_id bigint, tmdb_movie_id bigint, error string"
    )
    got = m.apply_outcome(queue, outcome).orderBy("tmdb_movie_id")
    assert rows_of(got, "hydrate_status", "hydrate_attempts", "last_error") == [
        ("failed", 1, "boom"),
        ("completed", 3, None),
        (None, 1, "kept"),
    ]
    assert [r["hydrated_at"] is not None for r in got.collect()] == [False, True, False]


def test_clear_subject_claims(spark, frame):
    claims = frame("wikidata_claims", {"subject_wikidata_id": "Q1"}, {"subject_wikidata_id": "Q2"})
    left = m.clear_subject_claims(claims, spark.createDataFrame([("Q1",)], "subject_wikidata_id string"))
    assert rows_of(left, "subject_wikidata_id") == [("Q2",)]


def split_plan(spark, df) -> str:
    """The final plan after running with low thresholds for skewed joins."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        made = df()
        made.collect()
        return made._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, path):
    """Rows of which four fifths have one parent, from several files."""
    rows = spark.range(0, 40_000, 1, 8).selectExpr("case when id % 5 > 0 then 7 else id end as p", "id as k", "uuid() as v", "id as at")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_a_hot_parent_is_split_when_its_children_are_replaced(spark, tmp_path):
    rows = hot_rows(spark, str(tmp_path / "rows"))
    parents = spark.range(0, 30_000, 3).withColumnRenamed("id", "p")
    empty = rows.limit(0)
    plan = split_plan(spark, lambda: m.replace_children(rows.drop("at"), empty, parents, "p", ["p", "k"], ["at"]))
    assert "skew=true" in plan


def test_a_hot_subject_is_split_when_its_claims_are_cleared(spark, tmp_path):
    rows = hot_rows(spark, str(tmp_path / "rows")).withColumnRenamed("p", "subject_wikidata_id")
    subjects = spark.range(0, 30_000, 3).withColumnRenamed("id", "subject_wikidata_id")
    assert "skew=true" in split_plan(spark, lambda: m.clear_subject_claims(rows, subjects))


def test_a_hot_remote_id_is_summed_before_the_shuffle(spark, tmp_path):
    rows = hot_rows(spark, str(tmp_path / "rows")).selectExpr("k as l", "p as r", "at")
    links, rejects = m.upsert_links(None, rows, "l", "r", ["at"])
    assert links.where("r = 7").collect()[0]["l"] == 1 and rejects.count() == 31_999
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("partial_") >= 2


def test_gate_checks_every_reference(spark, frame):
    titles = frame("titles", {"imdb_id": "t1"}, {"imdb_id": "t2"})
    people = frame("people", {"imdb_name_id": "n1"})
    rows = frame(
        "credits",
        {"imdb_id": "t1", "imdb_name_id": "n1"},
        {"imdb_id": "t1", "imdb_name_id": "n9"},
        {"imdb_id": "t9", "imdb_name_id": "n1"},
    )
    kept = gate(rows, [(titles, "imdb_id", "imdb_id"), (people, "imdb_name_id", "imdb_name_id")])
    assert rows_of(kept, "imdb_id", "imdb_name_id") == [("t1", "n1")]
    edges = frame(
        "episode_edges", {"imdb_id": "t1", "parent_imdb_id": "t2"}, {"imdb_id": "t1", "parent_imdb_id": "t9"}
    )
    both = gate(edges, [(titles, "imdb_id", "imdb_id"), (titles, "imdb_id", "parent_imdb_id")])
    assert rows_of(both, "parent_imdb_id") == [("t2",)]


def test_explode_ids_numbers_from_one(spark):
    df = spark.createDataFrame([("t1", "b,a"), ("t2", None)], "t string, ids string")
    assert sorted(rows_of(explode_ids(df, "ids", "p"))) == [("t1", "a", 2), ("t1", "b", 1)]
