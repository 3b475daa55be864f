"""Folds by a number of arrival against the folds by structs, and their plans."""

from __future__ import annotations

import random

import pytest
from conftest import rows_of

from celluloid.operators import mutations as m
from celluloid.sources.tsv import arrived

ROWS = "k long, j string, a string, b string, _arrival long"


@pytest.fixture(scope="module", params=[1, 2, 3])
def batches(spark, request):
    rng = random.Random(request.param)
    text = lambda: rng.choice([None, "x", "y", "z"])
    key = lambda: (rng.randrange(12) if rng.random() < 0.9 else None, rng.choice(["p", "q"]))
    old = {key(): (text(), text()) for _ in range(10)}
    stored = [(*k, *v) for k, v in old.items()] + [(None, "p", "twice", None), (None, "p", "twice", None)]
    new = [(*key(), text(), text(), n) for n in rng.sample(range(1 << 40), 60)]
    return spark.createDataFrame(stored, "k long, j string, a string, b string"), spark.createDataFrame(new, ROWS).repartition(3)


def both_ways(fold, batch):
    """By the arrival alone, and by two order columns that say the same."""
    dense = fold(batch, ["_arrival"])
    wide = fold(batch.selectExpr("k", "j", "a", "b", "_arrival as o1", "_arrival as o2"), ["o1", "o2"])
    columns = ["k", "j", "a", "b"]
    return sorted(rows_of(dense, *columns), key=str), sorted(rows_of(wide, *columns), key=str)


@pytest.mark.parametrize("with_stored", [True, False])
@pytest.mark.parametrize("nullable", [("k",), ()])
def test_same_rows(batches, with_stored, nullable):
    stored, batch = batches
    if not nullable:
        stored, batch = stored.where("k is not null"), batch.where("k is not null")
    stored = stored if with_stored else None
    folds = [
        lambda rows, order: m.upsert(stored, rows, ["k", "j"], order, nullable),
        lambda rows, order: m.insert_ignore(stored, rows, ["k", "j"], order, nullable),
        lambda rows, order: m.upsert_columns(stored, rows, ["k", "j"], order, ["b"], nullable),
    ]
    if not nullable:
        folds.append(lambda rows, order: m.merge_non_null(stored, rows, ["k", "j"], order))
    for fold in folds:
        dense, wide = both_ways(fold, batch)
        assert dense == wide


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_rows_are_sorted_to_be_aggregated(batches):
    stored, batch = batches
    for df in (
        m.upsert(stored, batch, ["k", "j"], ["_arrival"], ("k",)),
        m.insert_ignore(stored, batch, ["k", "j"], ["_arrival"], ("k",)),
        m.upsert_columns(stored, batch, ["k", "j"], ["_arrival"], ["a"], ("k",)),
        m.merge_non_null(stored, batch, ["k", "j"], ["_arrival"]),
    ):
        assert "SortAggregate" not in plan(df) and "HashAggregate" in plan(df)
    # a stored row is not aggregated: its side has one exchange, for the join
    assert plan(m.upsert(stored, batch, ["k", "j"], ["_arrival"])).count("LeftAnti") == 1


def test_arrival_follows_file_block_and_line(spark):
    rows = [("b", 0, 5), ("a", 9, 1 << 33), ("a", 0, (7 << 33) + 3), ("a", 0, (7 << 33) + 4), ("b", 0, 6)]
    staged = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "_file string, _block long, _line long, n int")
    assert [r["n"] for r in arrived(staged).orderBy("_arrival").collect()] == [2, 3, 1, 0, 4]
