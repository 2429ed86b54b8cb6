"""Every query against its SQL over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = duck.execute(entry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in found.description}
    assert sorted(kinds) == columns
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    order = [list(kinds).index(c) for c in columns]
    want = ordered([[row[i] for i in order] for row in found.fetchall()])
    assert ordered(df.select(*columns).collect()) == want
    assert want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 7
