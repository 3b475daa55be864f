"""Lookups through the name index: the rows of a full scan, from few files."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from conftest import rows_of

from celluloid.operators import lookup
from celluloid.operators.names import NameIndex, pattern_grams

WORDS = ["Quiet", "Harbour", "naïve", "ÀÉ", "sea", "100%", "a_b", "North", "tt0000007", "x", "LANTERN"]


@pytest.fixture(scope="module")
def titles(spark, frame):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        name = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
        rows.append({"imdb_id": f"tt{k:07}", "primary_title": name(k % 5) if k % 11 else None, "original_title": name(2) if k % 3 else None, "start_year": 1990 + k % 7})
    rows.append({"imdb_id": "tt9999999", "primary_title": "The Only Zeppelin", "original_title": "İstanbul Kelvin K"})
    return frame("titles", *rows)


@pytest.fixture(scope="module")
def index(titles, tmp_path_factory):
    return lookup.title_names(titles).save(str(tmp_path_factory.mktemp("names")))


@pytest.mark.parametrize("query", ["harb", "HARBOUR sea", "quiet%north", "a_b", "ïve", "àé", "ÀÉ", "zz", "", "x", "tt0000007", "only _eppelin", "k", "İst", "%%", "sea_", "kelvin K"])
def test_same_rows_as_a_scan(titles, index, query):
    assert rows_of(lookup.lookup_title(index, query, 1_000)) == rows_of(lookup.lookup_title(titles, query, 1_000))


def test_grams_of_patterns():
    assert pattern_grams("ReD _i") == ["ed ", "red"]
    assert pattern_grams("ab%cd_ef") == [] == pattern_grams("")
    assert pattern_grams("ÀBcd") == ["bcd", "Àbc"]


def files_read(df) -> int:
    """Files that the scan of the records opens."""
    df.collect()
    scans = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec" and "records" in node.relation().location().rootPaths().head().toString():
            scans.append(node.metrics().apply("numFiles").value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    assert scans
    return sum(scans)


def test_few_files_are_opened(titles, index):
    path = Path(index.records.inputFiles()[0].removeprefix("file:")).parent.parent
    every = len(list(path.rglob("*.parquet")))
    assert every >= 60
    assert files_read(lookup.lookup_title(index, "eppelin")) <= 2  # its own folder and that of the query as an id
    assert files_read(lookup.lookup_title(index, "tt0000007 no such")) <= 1
    assert files_read(lookup.lookup_title(index, "ze")) == every


def test_people_and_no_rows(spark, frame, tmp_path):
    people = frame("people", {"imdb_name_id": "nm1", "primary_name": "Ilse Brandt"}, {"imdb_name_id": "nm2"})
    index = lookup.person_names(people).save(str(tmp_path / "p"))
    assert rows_of(lookup.lookup_person(index, "se br"), "imdb_name_id") == [("nm1",)]
    assert rows_of(lookup.lookup_person(index, "nm2"), "imdb_name_id") == [("nm2",)]
    none = NameIndex.build(people.where("false").select(*lookup.PERSON_RECORD), "imdb_name_id", ["primary_name"])
    assert lookup.lookup_person(none, "anything").count() == 0
