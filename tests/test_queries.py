"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402
from celluloid.adapters import queries as _queries  # noqa: E402

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value) -> str:
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    own = set(_queries.queries())
    assert own <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = driver.queries()[name](spark, str(DATA))
    wanted = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(got.columns) == sorted(columns)
    at = [columns.index(c) for c in got.columns]
    expected = sorted(tuple(plain(row[i]) for i in at) for row in wanted.fetchall())
    assert sorted(tuple(map(plain, row)) for row in got.collect()) == expected


def test_entry(spark):
    assert driver.entry(spark).columns == ["person_id", "person_name", "shared_titles"]
