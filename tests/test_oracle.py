"""Every registered query against its DuckDB oracle on the tiny test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_TINY
from tools.check_oracle import SPARK_TO_DUCK, rows_of

ORACLE = entry.oracle_sql()
NAMES = sorted(n for n in entry.queries() if n in ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF_TINY).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_TINY)
    rel = con.sql(ORACLE[name])
    cols = rel.columns
    assert sorted(df.columns) == sorted(cols)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: SPARK_TO_DUCK.get(spark_types[c], spark_types[c]) for c in cols} == \
        {c: str(t) for c, t in zip(cols, rel.types)}
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, rel.fetchall())
