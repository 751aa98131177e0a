"""Registered queries against their SQL on the smallest tables.  Set
REGISTRY=all to run every query (a few minutes)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import checks

FOLDER = "/root/testdata/sf0.001"
CORE = """customer_analytics campaign_performance sales_performance customer_ltv prediction_results bq1_top_customers bq3_product_profit
bq4_store_month bq5_loyalty_spend bq6_lapsed_customers bq7_campaign_roi dim_upsert_missing recompute_transaction_total agg_median agg_sales_rollup
campaign_ranking dq_orphans dq_check_constraints features stratified_split prompts_batch report_number_check append_prediction scan_csv_project""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in checks.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()) if os.environ.get("REGISTRY") == "all" else CORE)
def test_query_matches_sql(spark, con, name):
    text, _seconds, good = checks.compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert good, text


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 150


def test_declared_columns_are_the_stored_ones(spark):
    from cartwheel.sources.bindings import RAW, raw_table

    for name in RAW:
        stored = spark.read.parquet(f"{FOLDER}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in raw_table(spark, FOLDER, name).schema] == [(f.name, f.dataType) for f in stored]
