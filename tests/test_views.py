from decimal import Decimal

import pytest
from conftest import AS_OF, rows
from pyspark.sql import functions as F

from cartwheel.functions import customer as C
from cartwheel.operators.select import slice_rows
from cartwheel.plans import business as B
from cartwheel.plans import dashboards as D
from cartwheel.plans import views as V


def test_customer_analytics_edges(tiny):
    got = rows(V.customer_analytics(tiny, as_of=AS_OF), "CustomerID")
    assert len(got) == 4
    nobody = got[3]
    assert (nobody["NumTransactions"], nobody["TotalAmountSpent"], nobody["AveragePurchaseValue"]) == (0, 0.0, 0.0)
    assert (nobody["NumCampaignsReceived"], nobody["CampaignResponseRate"], nobody["AverageDiscountReceived"]) == (0, 0.0, 0.0)
    assert nobody["DaysSinceLastPurchase"] is None and nobody["PurchaseCompleted"] is None and nobody["LoyaltyLevel"] is None
    one = got[1]
    assert one["Age"] == 24 and got[2]["Age"] == 23
    assert one["DaysSinceLastPurchase"] == 1
    # equal dates: the higher id is newer
    assert one["PurchaseCompleted"] is False
    assert (one["NumCampaignsReceived"], one["CampaignResponseRate"]) == (2, 50.0)
    assert (one["NumDistinctProductsPurchased"], one["AverageDiscountReceived"]) == (2, pytest.approx(0.5 / 3))
    assert (one["NumTransactions"], one["AveragePurchaseValue"]) == (2, 7.505)
    # a transaction without lines still counts
    assert (got[4]["NumTransactions"], got[4]["NumDistinctProductsPurchased"]) == (1, 0)


def test_latest_response_can_be_left_out_of_the_rate(tiny):
    got = rows(V.customer_analytics(tiny, as_of=AS_OF, exclude_latest=True), "CustomerID")
    assert (got[2]["NumCampaignsReceived"], got[2]["CampaignResponseRate"], got[2]["PurchaseCompleted"]) == (1, 0.0, True)
    assert (got[1]["NumCampaignsReceived"], got[1]["CampaignResponseRate"]) == (1, 100.0)
    assert (got[4]["NumCampaignsReceived"], got[4]["CampaignResponseRate"]) == (0, 0.0)


def test_functions_agree_with_the_view(tiny):
    view = rows(V.customer_analytics(tiny, as_of=AS_OF), "CustomerID")
    cents = lambda x: Decimal(str(x)).quantize(Decimal("0.01"), "ROUND_HALF_UP")
    for r in C.customer_age(tiny, as_of=AS_OF).collect():
        assert r.Age == view[r.CustomerID]["Age"]
    for r in C.customer_lifetime_value(tiny).collect():
        assert r.CustomerLifetimeValue == cents(view[r.CustomerID]["TotalAmountSpent"])
    for r in C.average_purchase(tiny).collect():
        assert r.AveragePurchase == cents(view[r.CustomerID]["AveragePurchaseValue"])
    for r in C.campaign_response_rate(tiny).collect():
        assert r.CampaignResponseRate == cents(view[r.CustomerID]["CampaignResponseRate"])
    for r in C.days_since_last_purchase(tiny, as_of=AS_OF).collect():
        assert r.DaysSinceLastPurchase == view[r.CustomerID]["DaysSinceLastPurchase"]


def test_one_customer(tiny):
    assert [r.CustomerID for r in V.customer_metrics(tiny, customer_id=2, as_of=AS_OF).collect()] == [2]
    whole = rows(V.customer_analytics(tiny, as_of=AS_OF), "CustomerID")[2]
    assert V.customer_metrics(tiny, customer_id=2, as_of=AS_OF).first().asDict() == whole
    assert C.average_purchase(tiny, customer_id=3).first().AveragePurchase == 0
    assert C.customer_age(tiny, as_of=AS_OF, customer_id=77).collect() == []


def test_campaign_performance_edges(tiny):
    got = rows(V.campaign_performance(tiny), "CampaignID")
    assert (got[3]["CustomersContacted"], got[3]["TotalRevenueGenerated"], got[3]["AveragePurchaseAmount"]) == (0, 0.0, 0.0)
    assert got[3]["OpenRate"] is None and got[3]["PurchaseCompletionRate"] is None
    # responses, but no purchase
    assert (got[4]["PurchaseCompletionRate"], got[4]["AveragePurchaseAmount"]) == (0.0, 0.0)
    assert (got[2]["OpenRate"], got[2]["PurchaseCompletionRate"], got[2]["AveragePurchaseAmount"]) == (100.0, 50.0, 30.0)
    assert [r.CampaignID for r in V.campaign_summary(tiny).collect()] == [2, 1, 3, 4]
    assert [r.CampaignID for r in V.campaign_summary(tiny, campaign_id=4).collect()] == [4]


def test_sales_totals_agree(tiny):
    sales = V.sales_performance(tiny)
    assert sales.agg(F.sum("Revenue")).first()[0] == 16.5
    levels = V.sales_rollup(tiny, ("StoreID", "CategoryID")).collect()
    top = [r for r in levels if r.GroupingLevel == 3][0]
    # transaction 10 spans two categories and counts once
    assert (top.Revenue, top.UnitsSold, top.TransactionCount) == (16.5, 7, 3)
    store = [r for r in levels if r.GroupingLevel == 1 and r.StoreID == 1][0]
    assert (store.Revenue, store.TransactionCount) == (14.5, 2)


def test_prediction_results(tiny):
    got = rows(V.prediction_results(tiny), "CustomerID")
    assert (got[1]["PredictionProbability"], got[1]["PredictionCorrect"]) == (Decimal("0.5000"), False)
    assert got[2]["PredictionCorrect"] is True
    assert got[3]["PredictionCorrect"] is None and got[4]["PredictionCorrect"] is None
    matrix = {(r.Actual, r.Predicted): r.RecordCount for r in D.confusion_matrix(tiny).collect()}
    assert matrix == {(False, "Yes"): 1, (True, "Yes"): 1}


def test_lapsed_customers_boundary(tiny):
    got = [(r.CustomerID, r.DaysSinceLastPurchase) for r in B.lapsed_customers(tiny, as_of=AS_OF).collect()]
    # never bought first; exactly six months ago is not lapsed
    assert got == [(3, None), (4, 185)]


def test_roi_is_null_without_discount(tiny):
    got = [(r.CampaignID, r.ROI) for r in B.campaign_roi(tiny).collect()]
    assert [g[0] for g in got] == [1, 2]
    assert got[0][1] == pytest.approx(70 / 30) and got[1][1] is None


def test_business_questions(tiny):
    assert [(r.CustomerID, r.RevenueRank) for r in B.top_customers(tiny).collect()] == [(1, 1), (2, 2), (4, 3)]
    assert B.best_campaign(tiny).first().CampaignID == 1  # 50 % twice: lower id
    profit = rows(B.product_profit(tiny), "ProductID")
    assert (profit[2]["TotalProfit"], profit[2]["ProfitRank"], profit[1]["UnitsSold"]) == (8.0, 1, 3)
    assert B.store_month(tiny).first().MonthlyRevenue == 10.0
    spend = {r.LevelName: (r.AvgSpendPerCustomer, r.CustomerCount) for r in B.loyalty_spend(tiny).collect()}
    assert spend == {"Bronze": (15.01, 1), "Diamond": (7.0, 1), "Platinum": (0.0, 1)}


def test_measures_and_dashboards(tiny):
    kpis = D.kpis(tiny).first()
    assert (kpis.TotalCustomers, kpis.ActiveCustomers, kpis.TotalCampaigns, kpis.CampaignResponseRate) == (4, 3, 4, 40.0)
    assert (kpis.PredictionAccuracy, str(kpis.LastReportDate)) == (0.8, "2024-01-03 00:00:00")
    assert D.response_rate(tiny).first()[0] == 0.4
    assert D.predicted_responders(tiny).first()[0] == 3
    assert D.total_clv(tiny).first()[0] == 22.01
    assert D.latest_report_text(tiny).first().AIReportID == 3
    recency = {r.BinStart: r.RecordCount for r in D.recency_histogram(tiny, as_of=AS_OF).collect()}
    assert recency == {0.0: 1, 180.0: 2, None: 1}
    assert {r.LoyaltyLevel: r.RecordCount for r in D.loyalty_distribution(tiny).collect()} == {"Bronze": 1, "Diamond": 1, "Platinum": 1, None: 1}
    funnel = rows(D.campaign_funnel(tiny), "CampaignID")
    assert [funnel[1][c] for c in ("Contacted", "Opened", "CouponUsed", "Purchased")] == [2, 1, 1, 1]
    ranks = {r.CampaignID: r.RevenueRank for r in D.campaign_ranking(tiny).collect()}
    assert ranks == {2: 1, 1: 2, 3: 3, 4: 3}
    assert [r.ResponseID for r in D.campaign_drillthrough(tiny, campaign_id=4).collect()] == [5]
    bins = {r.Bin: r.RecordCount for r in D.probability_histogram(tiny).collect()}
    assert bins == {9: 1, 5: 1, 7: 1, 1: 1}
    assert {r.NumTransactions: r.RecordCount for r in D.purchase_frequency(tiny).collect()} == {0: 1, 1: 2, 2: 1}


def test_slicers(tiny):
    sales = tiny["SalesTransaction"].join(tiny["Store"], "StoreID")
    assert slice_rows(sales).count() == 4
    sliced = slice_rows(sales, province="North", start="2023-08-01", end="2024-01-01", date_column="TransactionDate")
    assert [r.TransactionID for r in sliced.collect()] == [12]
    with pytest.raises(ValueError):
        slice_rows(sales, start="2024-01-01")
    assert slice_rows(tiny["CampaignResponse"], campaign=2).count() == 2


def test_approximate_distinct_products(tiny):
    got = rows(V.customer_analytics(tiny, as_of=AS_OF, approx_distinct=True), "CustomerID")
    assert [got[i]["NumDistinctProductsPurchased"] for i in (1, 2, 3, 4)] == [2, 1, 0, 0]


def test_hot_product_is_split_by_skew_join(spark, tiny):
    """A third of the lines on one product: the join on products splits it."""
    lines = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").alias("TransactionItemID"), (F.col("id") % 20_000).alias("TransactionID"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5_000).alias("ProductID"),
        F.lit(1).alias("Quantity"), F.lit("1.00").cast("decimal(10,2)").alias("LineTotal"),
    )
    tables = {
        **tiny, "SalesTransactionItem": lines,
        "SalesTransaction": spark.range(20_000).selectExpr("id AS TransactionID", "1L AS StoreID", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS TransactionDate"),
        "Product": spark.range(5_000).selectExpr("id AS ProductID", "id % 2 + 1 AS CategoryID"),
    }
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sales = V.sales_performance(tables)
        assert sales.agg(F.sum("UnitsSold")).first()[0] == 60_000
        sales.collect()
        assert "skew=true" in sales._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sales_cells_count_each_transaction_once(spark):
    # a repeated transaction in two stores, categories that are NULL, repeated lines
    lines = [(1, 1, 2, 5), (1, 1, 2, 5), (1, 2, 1, 7), (1, 3, 1, 1), (2, 3, 4, 2), (2, 3, 1, 2), (3, 2, 1, 9), (None, 1, 1, 1)]
    tables = {
        "SalesTransactionItem": spark.createDataFrame(lines, "TransactionID long, ProductID long, Quantity int, LineTotal int").withColumn(
            "LineTotal", F.col("LineTotal").cast("decimal(18,4)")),
        "Product": spark.createDataFrame([(1, 20), (2, 10), (3, None)], "ProductID long, CategoryID long"),
        "SalesTransaction": spark.createDataFrame([(1, 1, "2024-01-05"), (1, 2, "2024-01-05"), (2, 1, "2024-02-01"), (3, 2, "2023-02-01")],
                                                  "TransactionID long, StoreID long, day string").withColumn("TransactionDate", F.to_timestamp_ntz("day")),
    }
    got = {(r.SalesYear, r.StoreID, r.CategoryID): (int(r.Revenue), r.UnitsSold, r._in, r._first)
           for r in V.sales_cells(tables, ["SalesYear", "StoreID", "CategoryID"]).collect()}
    assert got == {
        (2024, 1, 20): (10, 4, 1, 0), (2024, 1, 10): (7, 1, 1, 1), (2024, 1, None): (5, 6, 2, 1),
        (2024, 2, 20): (10, 4, 1, 0), (2024, 2, 10): (7, 1, 1, 1), (2024, 2, None): (1, 1, 1, 0), (2023, 2, 10): (9, 1, 1, 1)}
    plan = V.sales_cells(tables, ["SalesYear", "CategoryID"])._jdf.queryExecution().executedPlan().toString()
    # no task holds a map of its transactions
    assert "HashAggregate(keys=[TransactionID" not in plan


def test_all_lines_meet_their_transactions_by_hash(tiny):
    plan = V.customer_analytics(tiny, as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan
