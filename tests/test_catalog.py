"""Every catalogue query against its SQL in DuckDB."""

import duckdb
import pytest

from roadloom import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("customer", "events", "lineitem", "orders")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, name):
    df = catalog.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    sql = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in sql.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(r[names.index(c)] for c in order) for r in sql.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    assert len(got) == len(want) > 0
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_kernels_give_a_row_each(spark, name):
    df = catalog.queries()[name](spark, SF)
    rows = df.collect()
    key = [c for c in ("scenario_id", "track_id", "element_id", "light_id") if c in df.columns]
    assert len(rows) == len({tuple(r[c] for c in key) for r in rows}) > 0
