from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from celluloid import build_session, table_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of a warehouse table, given as dicts; columns left out are null."""

    def make(table: str, *rows: dict):
        schema = table_schema(table)
        return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)

    return make


def rows_of(df, *columns) -> list[tuple]:
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
