"""Every registered query against its SQL in DuckDB, on the same tables."""

import duckdb
import pytest

from tessera.plans.catalogue import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(tuple, df.astype(object).where(df.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, DIR).toPandas()
    assert len(got)
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
        want = con.sql(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
