"""Every query that has SQL gives the rows that DuckDB gives, at the smallest size."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def canonical(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, (tuple(None if pd.isna(x) else int(x) if isinstance(x, float) and x == int(x) else x for x in r) for r in df.itertuples(index=False, name=None))))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = entry.queries()[name](spark, SF).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_entry_and_archives(spark):
    assert entry.entry(spark).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert entry.queries()["q36_nested_archives"](spark, SF).count() == docs
