"""Every query against its SQL, on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def sorted_rows(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v) for v in r])


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    sql = entry_points.oracle_sql()[name]
    columns = sorted(df.columns)
    assert columns == sorted(duck.sql(sql).columns)
    expected = duck.sql(sql).project(", ".join(f'"{c}"' for c in columns)).fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(got) == len(expected) > 0 or name.startswith("filter_points")
    for mine, theirs in zip(sorted_rows(got), sorted_rows(expected)):
        for a, b in zip(mine, theirs):
            assert a == b or math.isclose(a, b, abs_tol=1e-9)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_every_query_of_the_reference_has_its_sql():
    own = [n for n in entry_points.queries() if not (n.startswith("op") or n == "pipeline")]
    assert set(own) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["c_mktsegment", "avg"]
