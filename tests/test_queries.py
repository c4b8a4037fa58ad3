"""Every registered query against its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from rowtide.plans import registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def lines(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert lines(df.collect(), df.columns) == lines(cur.fetchall(), names)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracles())
    assert set(registry.queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["key", "value", "expires_at"]
