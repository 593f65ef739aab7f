"""Every registered query with an oracle, against DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from spanlake.plans import catalog, wire_catalog  # noqa: F401  (adds its queries to the catalog)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(int(value)) if isinstance(value, bool) else f"{value:.9g}" if type(value).__name__ == "Decimal" else str(value)


def test_queries_and_oracles_have_the_same_names():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    mine = catalog.QUERIES[name](spark, SF)
    theirs = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(mine.columns) == sorted(names)
    got = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in mine.collect())
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in theirs.fetchall())
    got, want = ([tuple(x[:-2] if x.endswith(".0") else x for x in r) for r in rows] for rows in (got, want))
    assert got == want
