"""Every registered report against its SQL oracle (DuckDB) on sf0.001,
plus the driver contract."""

import collections
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from lakeloom.plans import registry  # noqa: E402
from oracle_check import TABLES, table_rows  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["r_name", "n_name", "order_count", "revenue"]
    assert df.count() > 0


def test_entry_point_offers_every_report():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_every_report_has_sql():
    missing = sorted(set(QUERIES) - set(SQL))
    assert missing == [], missing


@pytest.mark.parametrize("name", sorted(SQL))
def test_report_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    scols, sbag = table_rows(df.columns, df.collect())
    res = con.execute(SQL[name])
    dcols, dbag = table_rows([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert sbag == dbag, (list((sbag - dbag).items())[:2], list((dbag - sbag).items())[:2])


@pytest.mark.parametrize("name", ["q9_bronze_audit", "q10_gold_audit", "med_bronze_customer", "t9_t11_time_functions",
                                  "t1_t11_date_functions", "r5_resample_weekly"])
def test_reports_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = QUERIES[name](spark, SF)
        scols, sbag = table_rows(df.columns, df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(SQL[name])
    dcols, dbag = table_rows([d[0] for d in res.description], res.fetchall())
    assert scols == dcols and sbag == dbag
