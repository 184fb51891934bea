"""Every registered query with SQL against DuckDB on the same small tables."""

import duckdb
import pandas as pd
import pytest

from weftline.plans.all_queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return "null"
        return f"{x:.6f}" if isinstance(x, float) else f"{x}.000000" if isinstance(x, int) and not isinstance(x, bool) else str(x)

    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in ORACLE_SQL:
        want = duck.execute(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
