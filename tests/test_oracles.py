"""Every registered query against its SQL in DuckDB, over the whole tables."""

import math
from pathlib import Path

import duckdb
import pytest

from tally.plans import batch_queries, stream_queries

TESTDATA = Path("/root/testdata")
REGISTERED = {**batch_queries.QUERIES, **stream_queries.QUERIES}
QUERIES = {name: query for name, (query, _) in REGISTERED.items()}
ORACLES = {name: sql for name, (_, sql) in REGISTERED.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for scale in ("sf0.001", "sf0.01"):
        con.execute(f'CREATE SCHEMA "{scale}"')
        for file in (TESTDATA / scale).glob("*.parquet"):
            con.execute(f"""CREATE VIEW "{scale}".{file.stem} AS SELECT * FROM '{file}'""")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name, scale):
    got = QUERIES[name](spark, str(TESTDATA / scale))
    duck.execute(f"""SET schema = '"{scale}"'""")
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    expected = rows(columns, cursor.fetchall())
    actual = rows(got.columns, [tuple(r) for r in got.collect()])
    assert len(actual) == len(expected)
    for a, e in zip(actual, expected):
        assert len(a) == len(e)
        for x, y in zip(a, e):
            if isinstance(x, float):
                assert math.isclose(x, y, rel_tol=1e-12)
            else:
                assert type(x) is type(y) and x == y
