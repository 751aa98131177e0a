import uuid

import pytest
from conftest import AS_OF, rows
from pyspark.sql import functions as F

from cartwheel.operators import sinks
from cartwheel.plans import layouts
from cartwheel.plans import views as V


@pytest.fixture
def database(spark):
    name = f"layout_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sales(spark, n):
    """n transactions of two lines each; sizes are known to the planner."""
    txns = spark.range(n).select(F.col("id").alias("TransactionID"), (F.col("id") % 3).alias("StoreID"),
                                 F.lit("2024-01-05 10:00:00").cast("timestamp_ntz").alias("TransactionDate"))
    lines = spark.range(2 * n).select((F.col("id") % n).alias("TransactionID"), (F.col("id") % 5 + 1).alias("ProductID"), F.lit(1).alias("Quantity"),
                                      F.lit("1.25").cast("decimal(10,2)").alias("LineTotal"))
    return {"SalesTransaction": txns, "SalesTransactionItem": lines, "Product": spark.range(1, 6).selectExpr("id as ProductID", "id % 2 as CategoryID"),
            "Store": spark.range(3).selectExpr("id as StoreID", "'S' as StoreName", "'P' as Province"),
            "ProductCategory": spark.range(2).selectExpr("id as CategoryID", "'C' as CategoryName")}


def test_star_on_stored_facts_shuffles_no_transactions(spark, database):
    tables = sales(spark, 20_000)
    layouts.store_facts(tables, database, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")  # products are below, facts above
    try:
        stored = V.sales_performance(layouts.with_stored_facts(tables, database))
        assert "hashpartitioning(TransactionID" in plan(V.sales_performance(tables))
        assert "SortMergeJoin" in plan(stored) and "hashpartitioning(TransactionID" not in plan(stored)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, V.sales_performance(tables).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_customer_reads_one_bucket(spark, tiny, database):
    layouts.store_by_customer(tiny, database, 8)
    for customer in (1, 2, 3, 4, 99):
        got = layouts.customer_metrics(spark, database, customer, as_of=AS_OF)
        assert rows(got, "CustomerID") == rows(V.customer_metrics(tiny, customer_id=customer, as_of=AS_OF), "CustomerID")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # shows the pruning of every scan
    try:
        scans = plan(layouts.customer_metrics(spark, database, 99, as_of=AS_OF)).split("FileScan")[1:]
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    of_customers = [s for s in scans if "loyaltylevel[" not in s.split("Batched")[0].lower()]
    assert len(of_customers) >= 6
    for s in of_customers:
        assert "SelectedBucketsCount: 1 out of 8" in s and "EqualTo(CustomerID,99)" in s


def test_cube(spark, database):
    """Far more transactions than registers."""
    tables = sales(spark, 60_000)
    layouts.store_cube(tables, database)
    cube = spark.table(f"{database}.{layouts.CUBE}")
    for dims in (["StoreID", "CategoryID"], ["SalesYear", "StoreID"], ["CategoryID"]):
        got = {tuple(r[d] for d in dims): r for r in layouts.cube_rollup(cube, dims).collect()}
        want = {tuple(r[d] for d in dims): r for r in V.sales_rollup(tables, dims).collect()}
        assert got.keys() == want.keys()
        for key, r in got.items():
            assert (r.Revenue, r.UnitsSold) == (want[key].Revenue, want[key].UnitsSold)
            assert abs(r.TransactionCount / want[key].TransactionCount - 1) < 4 * layouts.SKETCH_ERROR
    with pytest.raises(ValueError, match="City"):
        layouts.cube_rollup(cube, ["City"])


def test_statistics_change_the_order_of_joins(spark, database):
    """A star whose selective side is written last: known row counts move it first."""
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(20_000).selectExpr("id % 5000 as a", "id % 40 as b", "id as v").write.saveAsTable(f"{database}.fact")
    spark.range(5000).selectExpr("id as a", "id as x").write.saveAsTable(f"{database}.wide")
    spark.range(40).selectExpr("id as b", "id as y").write.saveAsTable(f"{database}.narrow")
    settings = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        text = f"SELECT sum(v) FROM {database}.fact JOIN {database}.wide USING (a) JOIN {database}.narrow USING (b) WHERE y = 3"

        def first_joined():
            lines = spark.sql(text)._jdf.queryExecution().optimizedPlan().toString().splitlines()
            depth = {t: len(x) - len(x.lstrip(" :+-")) for x in lines for t in ("wide", "narrow") if f".{t}[" in x}
            return max(depth, key=depth.get)

        unknown, total = first_joined(), spark.sql(text).first()[0]
        status = sinks.refresh_statistics(spark, database, ["fact", "wide", "narrow"])
        assert {r.TableName: r.KnownRows for r in status.collect()} == {"fact": 20_000, "wide": 5000, "narrow": 40}
        assert (unknown, first_joined()) == ("wide", "narrow")
        assert spark.sql(text).first()[0] == total
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
