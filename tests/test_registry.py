"""Every registered query of the core against its SQL in DuckDB, on whole tables."""

import math
import numbers
import os

import duckdb
import pytest

from inkloom.plans import registry


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return con


def rows(df):
    def norm(v):
        if v is None or (isinstance(v, numbers.Number) and not isinstance(v, bool) and math.isnan(v)) or str(v) in ("<NA>", "NaT"):
            return ""
        return repr(round(float(v), 6)) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(norm, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, data, duck, name):
    got, want = registry.queries()[name](spark, data).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
