from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, sentences
from pyspark.sql import functions as F

from celluloid.llm import ngram_join


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(zip(*(words[k:] for k in range(width))))


def brute(rows, width, percent):
    """doc_id -> (size, smallest id reachable)"""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus(seed, copies=40):
    """Unlike texts, chains of near copies, exact copies, and a passage that many texts share."""
    rng = random.Random(seed)
    passage = sentences(999, 50)
    texts = []
    for k in range(60):
        texts.append(sentences(seed * 1000 + k, rng.randint(3, 120)) + (" " + passage if k % 2 else ""))
    chain = sentences(seed, 150).split()
    for k in range(copies):
        chain = chain.copy()
        for _ in range(rng.choice([0, 1, 2, 4])):
            chain[rng.randrange(len(chain))] = f"n{k}_{rng.random()}"
        texts.append(" ".join(chain))
    core = sentences(seed + 7, 140).split()
    for k in range(copies):
        near = core.copy()
        for _ in range(rng.choice([1, 2, 3])):
            near[rng.randrange(len(near))] = f"c{k}_{rng.random()}"
        texts.append("\n".join(near))
    texts += [texts[5], texts[5].upper(), texts[61], "one two", "One Two", "one", "", None, "   "]
    return list(enumerate(texts, start=100))


@pytest.mark.parametrize(("width", "percent", "short", "block"), [(3, 90, 32, 4096), (3, 90, 2, 7), (5, 80, 4, 16), (1, 50, 3, 11)])
def test_components_equal_brute_force(spark, monkeypatch, width, percent, short, block):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short)
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", block)
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", block)
    rows = corpus(width + percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(spark, rows), width, percent).collect()}
    assert got == brute(rows, width, percent)


def test_edge_rows(spark):
    text = sentences(1, 60)
    rows = [(None, text), (7, text), (7, text), (9, None), (9, None), (3, ""), (None, ""), (5, "lone text")]
    docs = documents(spark, rows).withColumn("shingle", F.lit(1)).withColumn("component_id", F.lit("clash"))
    got = ngram_join.join(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 58, 7), (7, 58, 7), (7, 58, 7), (9, 0, 9), (9, 0, 9), (3, 0, 3), (None, 0, None), (5, 1, 5)], key=str)
    assert ngram_join.join(docs.limit(0)).count() == 0
    kept = ngram_join.representatives(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 5, 7, 9, 9, None]


def test_representatives_go_by_text(spark):
    a, b, c = sentences(1, 60), sentences(2, 60), sentences(3, 60)
    rows = [(1, a), (2, a), (2, b), (None, b + " end"), (None, c), (None, c), (4, sentences(4, 60)), (4, sentences(5, 60)), (4, sentences(5, 60))]
    clash = {n: F.lit("clash") for n in ("head_id", "set_id", "row", "part", "bit", "rows", "component", "id")}
    docs = documents(spark, rows).withColumns(clash)
    kept = ngram_join.representatives(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, a), (2, b), (None, c), (4, sentences(4, 60)), (4, sentences(5, 60))], key=str)


def test_long_near_copies(spark):
    text = sentences(9, 5_000).split()
    rows = [(k, " ".join(text[:40] * (k > 20) + text[: 5_000 - 3 * k] + [f"own{k}"])) for k in range(60)]
    rows += [(100 + k, sentences(50 + k, 300) + " " + " ".join(text[:400])) for k in range(30)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(spark, rows)).collect()}
    assert got == brute(rows, 3, 90)


def test_derived_links_equal_direct_comparison():
    rng = np.random.default_rng(4)
    pivot = set(range(200))
    members = []
    for k in range(60):
        gone = set(rng.choice(200, rng.integers(0, 25), replace=False).tolist())
        members.append((k, (pivot - gone) | {1000 + int(x) for x in rng.integers(0, 60, rng.integers(0, 20))}))
    rows = []
    for k, s in members:
        linked = bool(ngram_join.links(200, len(s), len(s ^ pivot), 90))
        for probes in (True, False):
            if not probes or not linked:
                rows.append({"probes": probes, "b": k, "n": len(s), "linked": linked, "difference": sorted(s ^ pivot)})
    found = ngram_join.derive(pa.Table.from_pylist(rows), 90)
    near = {(a, b) for (a, s), (b, t) in combinations(members, 2) if 100 * len(s & t) >= 90 * len(s | t)}
    assert all(tuple(sorted(f)) in near for f in found)
    linked = {r["b"] for r in rows if r["linked"]}

    def groups(edges):
        parent = {k: k for k, _ in members} | {-1: -1}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in [*edges, *((k, -1) for k in linked)]:
            parent[root(a)] = root(b)
        return {frozenset(k for k, _ in members if root(k) == r) for r in {root(k) for k, _ in members}}

    assert groups(found) == groups(near)


def test_blocks_skip_only_what_cannot_link():
    rng = random.Random(2)
    for _ in range(30):
        order = list(range(40))
        sets = [sorted(rng.sample(order, rng.randint(8, 16))) for _ in range(20)]
        sets += [sorted({*s[:-1], rng.randrange(40)}) for s in sets]
        for token in order:
            rows = [(k, len(s), s.index(token)) for k, s in enumerate(sets) if token in s[: ngram_join.prefix_length(len(s), 80)]]
            if len(rows) < 2:
                continue
            found = {(a, b) for a, b, _ in ngram_join.list_pairs(*(np.array(c) for c in zip(*rows)), 80)}
            for (a, _, _), (b, _, _) in combinations(rows, 2):
                first = min(set(sets[a]) & set(sets[b]))
                if first == token and 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b])):
                    assert tuple(sorted((a, b))) in found


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 301), (301, 300)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 300: 300, 301: 300}
    assert ngram_join.components(spark.createDataFrame([], "a long, b long")).count() == 0
