"""Every registered query of the engine runs, and equals its SQL twin where it has one."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from kinlink.plans.registry import FLAGSHIP, ORACLES, QUERIES

DATA = os.environ.get("KINLINK_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    if not Path(DATA).exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def _plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    result = db.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(_plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == want


def test_flagship():
    assert FLAGSHIP in QUERIES
