"""Registered queries against their SQL, on tables small enough for a test run."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from atlasweave.plans import catalogue

HERE = "/root/testdata/sf0.001"
CHEAP = ["enrich_size_report", "tags_parse", "name_variants", "html_description", "distance_join", "sssp", "snapshot_diff", "tile_grid", "csv_scan", "csv_stream", "network_edges", "network_map", "wiki_lookup", "report_text"]

pytestmark = pytest.mark.skipif(not os.path.isdir(HERE), reason="no test tables")


def test_contract():
    assert set(catalogue.QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", CHEAP)
def test_as_duckdb(spark, name):
    db = duckdb.connect()
    for file in os.listdir(HERE):
        path = f"{HERE}/{file}" + ("/*.parquet" if os.path.isdir(f"{HERE}/{file}") else "")
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{path}')")
    want = db.execute(catalogue.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    key = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    got = catalogue.QUERIES[name](spark, HERE)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(key, got.select(*columns).collect()))) == sorted(map(str, map(key, want.fetchall())))


def test_distances_are_rounded_as_in_the_sql(spark, tmp_path):
    balances = [0.0, 0.04915, 0.02325, 0.19755, 0.20315, 149.99, 150.0, -150.0]
    db = duckdb.connect()
    db.execute(f"COPY (SELECT unnest(range({len(balances)})) * 97 AS c_custkey, unnest({balances}::DOUBLE[]) AS c_acctbal, 1 AS c_nationkey) TO '{tmp_path}/customer.parquet'")
    db.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    want = db.execute(catalogue.ORACLE_SQL["distance_join"]).fetchall()
    assert len(want) > 10 and sorted(want) == sorted(map(tuple, catalogue.QUERIES["distance_join"](spark, str(tmp_path)).collect()))


def test_entry(spark):
    assert driver.entry(spark).count() > 0
