"""Every registered query against its SQL, both over the whole tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry
from conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    """Those for training data have it where SQL can express them."""
    names = set(registry.queries())
    assert set(registry.oracle_sql()) <= names
    assert {n for n in names if not n.startswith("op") and n != "pipeline"} <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query(spark, duck, name):
    ours = registry.queries()[name](spark, SF_DIR)
    theirs = duck.sql(registry.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    # Same kinds of numbers, so that a value hash cannot differ by type.
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "double": "DOUBLE",
             "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    ours_types = {c: kinds[t] for c, t in ours.dtypes}
    assert ours_types == {c: str(t) for c, t in zip(theirs.columns, theirs.types)}
    got = Counter(tuple(r) for r in ours.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(theirs.select(quoted).fetchall())
    assert sum(got.values()) == sum(expected.values())
    assert got == expected


def test_entry(spark):
    assert registry.entry(spark).count() > 0
