"""Every query of the catalogue against its SQL on the smallest tables, and the driver contract."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from tessera import plans

duckdb = pytest.importorskip("duckdb")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)
    return [columns[k] for k in order], sorted([tuple(plain(r[k]) for k in order) for r in data])


@pytest.fixture(scope="module")
def views(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*' if path.is_dir() else ''}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_matches_sql(spark, sf_dir, views, name):
    df = plans.QUERIES[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = views.execute(plans.ORACLE_SQL[name])
    assert got == rows([c[0] for c in result.description], result.fetchall())


def test_entry(spark, sf_dir):
    assert spark_entry.entry(spark).count() > 0
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
