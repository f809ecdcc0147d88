"""Every query with SQL against DuckDB on the smallest tables; the others run twice alike."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from waymark.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        files = p / "*.parquet" if os.path.isdir(p) else p
        c.execute(f"create view {p.stem} as select * from read_parquet('{files}')")
    return c


def tidy(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 9) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([tuple(tidy(r[c]) for c in columns) for r in df.collect()], key=str)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        again = registry.queries()[name](spark, SF)
        assert got == sorted([tuple(tidy(r[c]) for c in columns) for r in again.collect()], key=str)
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted([tuple(tidy(r[i]) for i in at) for r in result.fetchall()], key=str)
