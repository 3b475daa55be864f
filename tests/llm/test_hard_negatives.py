"""Hard negatives against all scores."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from celluloid.llm import hard_negatives as hn
from celluloid.llm import queries

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3):
    known = []
    for vec_id, values, label in rows:
        if label is None or values is None or any(v is None or not math.isfinite(v) for v in values):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        known.append((vec_id, label, [max(-hn.LARGEST, min(hn.LARGEST, math.floor(256 * float(np.float32(v))))) for v in values]))
    last = lambda i: (i is None, i or 0)
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    made = []
    for k, (anchor, label, v) in enumerate(known):
        if anchor is None or anchor % 50:
            continue
        others = sorted(((-score(v, w), last(i), i, x) for n, (i, x, w) in enumerate(known) if n != k), key=lambda o: o[:2])
        for minus, _, i, _ in [o for o in others if o[3] == label][:positives]:
            window = [o for o in others if o[3] != label and 50 * -minus <= 100 * -o[0] <= 95 * -minus]
            made += [(anchor, i, n, o[2], -minus, -o[0]) for n, o in enumerate(window[:negatives], 1)]
    return sorted(made, key=str)


def mined(spark, tmp_path, rows, parts=4):
    given = spark.createDataFrame(rows, VECTORS).repartition(parts)
    given.withColumns({c: F.lit("clash") for c in ("point", "vec", "own", "tree", "marks", "anchor", "_line")}).write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted((tuple(r) for r in queries.op13_hard_negatives(spark, str(tmp_path)).collect()), key=str)


def clustered(count, seed, width=8, spread=0.1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, width)) * 2
    return [(k, (middles[k % 6] + rng.normal(size=width) * spread).tolist(), int(rng.integers(0, 4))) for k in range(count)]


def odd_rows():
    rows = clustered(150, 3)
    same = [1.5, -0.25, 0.5, 3.0, 0.0, 1.0, 1.0, -2.0]
    rows += [(1_000 + 10 * k, same, k % 2) for k in range(40)]  # one vector, two labels, many anchors
    rows += [(1_000, same, 0), (1_000, same, 0), (50, same, 1), (None, same, 0), (None, same, 1)]
    rows += [(2_000, None, 1), (2_050, same, None), (2_100, [1.0, None], 1), (2_150, [float("nan")] * 8, 1), (2_200, [float("inf")] * 8, 1)]
    rows += [(2_250, [], 2), (2_300, [2.0], 2), (2_350, [1.0] * 12, 2), (2_400, [0.0] * 8, 3), (2_450, [-1.0] * 8, 9), (2_500, [3e38, 1.0], 1)]
    return rows


def test_clusters_in_many_trees(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hn, "TREE_POINTS", 60)
    monkeypatch.setattr(hn, "GRID", 3)
    rows = clustered(700, 1)
    assert mined(spark, tmp_path, rows) == brute(rows)


def test_odd_rows(spark, tmp_path):
    assert mined(spark, tmp_path, odd_rows()) == brute(odd_rows())


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(50, [1.0], 1), (51, [2.0], 1)], [(50, [1.0], 1), (51, [2.0], 1), (52, [1.0], 2)]])
def test_small_tables(spark, tmp_path, rows):
    assert mined(spark, tmp_path, rows, 1) == brute(rows)


@pytest.mark.parametrize(("spread", "seed"), [(0.02, 5), (0.3, 6), (5.0, 7)])
def test_tree_search_is_exact_and_skips(spread, seed):
    rows = clustered(1_500, seed, 6, spread)
    at = np.floor(256 * np.array([r[1] for r in rows]))
    labels, ids = np.array([r[2] for r in rows]), [[r[0]] for r in rows]
    tree = hn.CoverTree.thaw(hn.CoverTree(at, labels, ids).freeze())
    covered = sorted(int(p) for p, n in zip(tree.child_point, tree.child_node) if n < 0)
    assert covered == list(range(len(rows)))
    for q in at[::100]:
        scores = at @ q
        top = int(np.sort(scores)[-200])
        for same, lows, highs, k in [(True, [-hn.FAR], [hn.FAR], 6), (False, [top // 2, 0], [top, top // 3], 3)]:
            got = tree.search(q, 1, same, lows, highs, k)
            for best, low, high in zip(got, lows, highs):
                fits = [(-int(s), i) for s, x, i in zip(scores, labels, range(len(rows))) if (x == 1) == same and low <= s <= high]
                assert best == [(-s, i) for s, i in sorted(fits)[:k]]


def test_bounds_hold():
    rng = np.random.default_rng(9)
    at = np.floor(rng.normal(size=(400, 5)) * 300)
    most = np.sqrt((at * at).sum(axis=1)).max()
    whole = np.hstack([at, np.sqrt(np.maximum(most**2 - (at * at).sum(axis=1), 0))[:, None]])
    for q in np.floor(rng.normal(size=(20, 5)) * 300):
        radius = np.sqrt(((whole[:, None] - whole[None]) ** 2).sum(axis=2))
        low, high = hn.bounds(np.repeat(at @ q, 400), radius.ravel(), most, float(q @ q))
        scores = np.tile(at @ q, 400)
        assert (low <= scores).all() and (scores <= high).all()
