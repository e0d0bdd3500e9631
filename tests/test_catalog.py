"""Every catalog query against its SQL on the smallest data."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from parcelforge import catalog

SF = Path("/root/testdata/sf0.001")


def _plain(rows: list, columns: list[str]) -> list:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    one = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{float(v):.6f}" if isinstance(v, (int, float, Decimal)) else str(v)
    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in SF.iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, str(SF))
    rows = [tuple(r) for r in got.collect()]
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert _plain(rows, got.columns) == _plain(cursor.fetchall(), columns)
