"""Every query of the engine against its SQL in DuckDB on the same tables."""

import duckdb
import pandas as pd
import pytest

from riboscan.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="session")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    cell = lambda x: None if x is None or x != x else round(float(x), 5) if isinstance(x, float) else str(x)
    return sorted((tuple(cell(x) for x in row) for row in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    ints = [c for c in got.columns if pd.api.types.is_numeric_dtype(got[c]) or pd.api.types.is_numeric_dtype(want[c])]
    for df in (got, want):
        df[ints] = df[ints].astype(float)
    assert plain(got) == plain(want)
