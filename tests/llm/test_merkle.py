"""The manifest against a plain tree in Python."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest
from helpers import DOCS
from pyspark.sql import functions as F

from celluloid.llm import merkle, queries


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, lowered: bool = False) -> str:
    doc_id, text, lang, source, n_chars = row
    if lowered and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Top, and per leaf the siblings left and right of it, level by level."""
    proofs, level, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for k, place in enumerate(at):
            run = level[place // 8 * 8 : place // 8 * 8 + 8]
            proofs[k].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
        level, at = [h(*level[k : k + 8]) for k in range(0, len(level), 8)], [p // 8 for p in at]
    return level[0], proofs


def expected(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    tops = {g: tree([leaf(r) for r in groups[g]]) for g in order}
    if not order:
        return []
    root, upper = tree([tops[g][0] for g in order])
    made = []
    for place, g in enumerate(order):
        for row, proof in zip(groups[g], tops[g][1]):
            chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            low, steps = leaf(row, chosen), proof + upper[place]
            for left, right in steps:
                low = h(left, low, right)
            made.append((row[0], leaf(row), tops[g][0], root, h(*(s for step in steps for s in step)), low, low == root))
    return sorted(made, key=str)


def rows_many():
    rows = [(k * 3, f"Text {k % 50} É" * (k % 4), ["en", "de", "é", "z"][min(3, k % 9)], f"s{k % 3}", k) for k in range(300)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (5, "", None, "", 0), (5, "A", "lone", "s", 1)]
    rows += [(7, "Same", "en", "s", 4), (7, "Same", "en", "s", 4), (7, "Other", "en", "s", 5), (900, "X" * 200_000, "long", "s", 200_000)]
    return rows


def run(spark, tmp_path, rows, repartition: int = 5):
    docs = spark.createDataFrame(rows, DOCS).repartition(repartition)
    # columns that the operator uses itself
    docs.withColumns({c: F.lit("clash") for c in ("tree", "place", "proof", "digest", "leaf", "altered", "root")}).write.parquet(str(tmp_path / "documents.parquet"))
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    got = queries.op11_merkle_manifest(spark, str(tmp_path)).select(*columns).collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("levels", [1, 5])
def test_against_a_plain_tree(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (levels,))
    assert run(spark, tmp_path, rows_many()) == expected(rows_many())


@pytest.mark.parametrize("count", [0, 1, 8, 9])
def test_small_tables(spark, tmp_path, count):
    rows = [(k, "Ab", "en", "s", 2) for k in range(count)]
    assert run(spark, tmp_path, rows, 1) == expected(rows)


def test_every_group_alone(spark, tmp_path):
    rows = [(k, "Ab", f"lang {k:03}", "s", 2) for k in range(70)]
    assert run(spark, tmp_path, rows) == expected(rows)


def test_sql_on_odd_rows(spark, tmp_path):
    got = run(spark, tmp_path, rows_many())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(queries.OP11_SQL).fetchall(), key=str) == got


def test_sweeps_keep_label_order():
    up, down = merkle.Queue(), merkle.Queue(reverse=True)
    for queue in (up, down):
        for level, place, slot in [(2, 0, 1), (1, 9, 0), (1, 2, 3), (2, 0, 0), (1, 2, 1)]:
            queue.send(level, place, slot, (level, place, slot))
    assert [up.take() for _ in range(3)] == [(1, 2, [(1, 2, 1), (1, 2, 3)]), (1, 9, [(1, 9, 0)]), (2, 0, [(2, 0, 0), (2, 0, 1)])]
    assert down.take() == (2, 0, [(2, 0, 0), (2, 0, 1)])
