"""Imports move the rows of a dataset once: to where the table has them."""

from __future__ import annotations

import random

import pytest
from conftest import rows_of

from celluloid import Warehouse
from celluloid.operators import mutations as m
from celluloid.operators.relational import gate
from celluloid.plans import bulk
from celluloid.sources.tsv import arrived

KEY = ["k", "j"]
COLUMNS = [*KEY, "a", "b"]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """As for tables of which nothing is small enough to be taken for it."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.fixture(scope="module", params=[1, 2, 3])
def batches(spark, request):
    rng = random.Random(request.param)
    text = lambda: rng.choice([None, "x", "y", "z"])
    key = lambda: (rng.randrange(12) if rng.random() < 0.8 else None, rng.choice(["p", "q", None]))
    # stored rows may repeat a key or lack it; whole rows may repeat too
    stored = [(*key(), text(), text()) for _ in range(20)] + [(3, "p", "twice", None)] * 2 + [(None, "p", "x", "x")] * 2
    new = [(*key(), text(), text(), n) for n in rng.sample(range(1 << 40), 80)]
    types = "k long, j string, a string, b string"
    return spark.createDataFrame(stored, types), spark.createDataFrame(new, f"{types}, _arrival long").repartition(3)


FOLDS = [
    lambda stored, rows, nullable, **how: m.upsert(stored, rows, KEY, ["_arrival"], nullable, **how),
    lambda stored, rows, nullable, **how: m.insert_ignore(stored, rows, KEY, ["_arrival"], nullable, **how),
    lambda stored, rows, nullable, **how: m.upsert_columns(stored, rows, KEY, ["_arrival"], ["b"], nullable, **how),
]


@pytest.mark.parametrize("with_stored", [True, False])
@pytest.mark.parametrize("nullable", [("k",), ("k", "j"), ()])
def test_folds_by_cuts_give_the_same_rows(batches, with_stored, nullable):
    stored, batch = batches
    stored = stored if with_stored else None
    for fold in FOLDS:
        plain, cut = fold(stored, batch, nullable), fold(stored, batch, nullable, cut=True)
        assert cut.columns == plain.columns
        assert sorted(rows_of(cut, *COLUMNS), key=str) == sorted(rows_of(plain, *COLUMNS), key=str)


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


def test_a_fold_moves_rows_once(batches, no_broadcast):
    stored, batch = batches
    for fold in FOLDS:
        for old in (stored, None):
            moves = exchanges(fold(old, batch, ("k",), cut=True))
            # (the batch of this test is dealt out before it is folded)
            assert ["rangepartitioning" in e for e in moves if "RoundRobin" not in e] == [True]


def test_numbering_does_not_move_rows(spark, tmp_path, no_broadcast):
    staged = [("b", 0, 5, "x"), ("a", 9, 1 << 33, "y"), ("a", 0, (7 << 33) + 3, "z")]
    spark.createDataFrame(staged, "_file string, _block long, _line long, v string").write.parquet(str(tmp_path / "s"))
    rows = arrived(spark.read.parquet(str(tmp_path / "s")))
    assert "SortMergeJoin" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r["v"] for r in rows.orderBy("_arrival").collect()] == ["z", "y", "x"]


def test_few_missing_ids_do_not_move_rows(spark, tmp_path):
    # far more ids than may be broadcast, of which one is missing
    spark.range(20_000).selectExpr("'t' || id as imdb_id").write.parquet(str(tmp_path / "titles"))
    refs = spark.range(40_000).selectExpr("case when id = 9 then null when id = 7 then 'gone' else 't' || (id % 20000) end as r", "id")
    refs.write.parquet(str(tmp_path / "rows"))
    titles, rows = (spark.read.parquet(str(tmp_path / n)) for n in ("titles", "rows"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        kept = gate(rows, [(titles, "imdb_id", "r")], bulk.missing_ids)
        assert not [e for e in exchanges(kept) if "Broadcast" not in e]
        assert kept.count() == 39_998 and rows_of(kept.where("id in (7, 9)")) == []
        assert sorted(rows_of(kept)) == sorted(rows_of(gate(rows, [(titles, "imdb_id", "r")])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_counted_folds_fill_the_table_as_plain_ones(spark, frame, tmp_path):
    stored = Warehouse(spark, str(tmp_path))
    stored.save("titles", frame("titles", *({"imdb_id": f"t{k}"} for k in range(8))))
    stored.save("people", frame("people", *({"imdb_name_id": f"n{k}"} for k in range(5))))
    rng, made = random.Random(7), None
    columns = "imdb_id string, imdb_name_id string, ordering long, category string, job string, characters string, source string, _arrival long"
    for _ in range(2):
        lines = [
            (f"t{rng.randrange(10)}", f"n{rng.randrange(6)}", rng.choice([None, 1]), rng.choice([None, "actor"]), rng.choice([None, "x"]), f"{n}", "imdb", n)
            for n in range(300)
        ]
        batch = spark.createDataFrame(lines, columns)
        gated = bulk.gate_table(batch, "credits", stored)
        made = bulk.fold_table("credits", stored.table("credits") if made is None else made, gated)
        made = spark.createDataFrame(made.collect(), made.schema)
        seen = gated.count()
        before = stored.table("credits").count()
        kept, counters = bulk.fold_counted("credits", batch, stored)
        assert kept.count() == seen < 300
        assert counters == bulk.import_counters(300, seen, before, made.count())
        for table in (stored.table("credits"), stored.ordered("credits", "imdb_name_id")):
            assert sorted(map(str, rows_of(table, *made.columns))) == sorted(map(str, rows_of(made)))
