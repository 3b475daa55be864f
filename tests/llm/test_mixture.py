from __future__ import annotations

import numpy as np
import pytest
from helpers import documents, sentences
from pyspark.sql import functions as F

from celluloid.llm import mixture


def test_flight_keeps_words_and_count_and_leaves_two():
    rng = np.random.default_rng(1)
    for count in (0, 1, 2, 3, 50, 700):
        size = rng.integers(1, 900, count).astype(float)
        chance = rng.random(count)
        flown = mixture.fly(size, chance, rng.random(max(count, 8)))
        assert ((flown > 0) & (flown < 1)).sum() <= 2
        assert abs((size * flown).sum() - (size * chance).sum()) < 1e-6 * max(1, size.sum())
        assert abs(flown.sum() - chance.sum()) < 1e-6
        landed = mixture.land(size, flown, rng.random(8))
        assert set(np.unique(landed)) <= {0.0, 1.0}


def test_flight_keeps_each_expectation():
    size, chance = np.array([5.0, 3.0, 2.0, 7.0, 4.0]), np.array([0.3, 0.6, 0.5, 0.2, 0.8])
    rng = np.random.default_rng(5)
    runs = [mixture.land(size, mixture.fly(size, chance, rng.random(8)), rng.random(8)) for _ in range(4000)]
    assert np.abs(np.mean(runs, axis=0) - chance).max() < 0.04


def expected_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    full, left = {}, float(sum(sizes.values()))
    while True:
        open_names = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_names)
        share = {s: left * weight[s] / total for s in open_names}
        over = [s for s in open_names if share[s] > 3 * sizes[s]]
        if not over:
            return share | full
        for s in over:
            full[s] = 3.0 * sizes[s]
            left -= full[s]


@pytest.mark.parametrize("block", [7, 2_000])
def test_mixture_meets_targets_and_reruns_agree(spark, monkeypatch, block):
    monkeypatch.setattr(mixture, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    sources = ["s0", "s1", "S2", "é", None, "tiny"]
    rows = [(k, sentences(k, int(rng.integers(1, 60))), "en", sources[0] if k % 3 == 0 else sources[k % 6]) for k in range(600)]
    rows = [r for r in rows if r[3] != "tiny"] + [(9_999, "only two", "en", "tiny")]
    docs = documents(spark, rows)
    mixed = mixture.mix(docs).toPandas()
    assert sorted(mixed["doc_id"]) == sorted(r[0] for r in rows)
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    goals = expected_targets(sizes)
    for source, goal in goals.items():
        own = mixed[mixed["source"].isna()] if source is None else mixed[mixed["source"] == source]
        assert abs(own["target"] - goal).max() < 1e-6 and (own["source_size"] == sizes[source]).all()
        assert abs(own["taken"].sum() - goal) <= max(0.01 * goal, 2)
    assert (mixed["taken"] <= 3 * mixed["size"]).all() and (mixed["taken"] % mixed["size"] == 0).all()
    again = mixture.mix(docs.repartition(5)).toPandas()
    assert mixed.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()


def test_source_order_is_by_code_point_with_null_last(spark):
    totals = spark.createDataFrame([(s,) for s in ["b", "a", None, "B", "é", "z"]], "source string")
    got = {r["source"]: r["position"] for r in mixture.ranked_sources(totals).collect()}
    assert got == {"B": 0, "a": 1, "b": 2, "z": 3, "é": 4, None: 5}


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (5, "same words"), (5, "same words"), (5, "same words")]
    docs = documents(spark, rows).withColumn("target", F.lit("clash")).withColumn("size", F.lit("clash"))
    mixed = mixture.mix(docs).toPandas()
    assert len(mixed) == 7 and mixed["size"].tolist().count(0) == 3
    assert mixed.loc[mixed["size"] == 0, "taken"].sum() == 0 and mixed["target"].iloc[0] == 9.0
    assert mixture.mix(docs.limit(0)).count() == 0
    assert mixture.mix(documents(spark, [(1, None)])).first()["target"] == 0.0


def test_a_large_id_survives_beside_a_null(spark):
    large = (1 << 62) + 1
    mixed = mixture.mix(documents(spark, [(large, "a b"), (None, "c d")]))
    assert {r["doc_id"] for r in mixed.collect()} == {large, None}
