"""Customer functions, named datasets, business questions, dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import customer as C
from cartwheel.plans import business as B
from cartwheel.plans import dashboards as D
from cartwheel.plans import views as V
from cartwheel.sources.bindings import ANALYTICS_AS_OF, SALES_AS_OF
from registry.canon import SALES_AS_OF as SALES_SQL
from registry.canon import age, count_if, days, money, pct, ratio
from registry.core import optional_numbers, query

# -- customer functions ---------------------------------------------------------


@query("customer_age", f"SELECT CustomerID, {age('DateOfBirth')} AS Age FROM @Customer")
def _(t, env):
    return C.customer_age(t, as_of=ANALYTICS_AS_OF)


@query("customer_lifetime_value", f"""SELECT c.CustomerID, coalesce({money('s.TransactionTotal')}, 0.0) AS CustomerLifetimeValue
    FROM @Customer c LEFT JOIN @SalesTransaction s ON s.CustomerID = c.CustomerID GROUP BY 1""")
def _(t, env):
    return C.customer_lifetime_value(t)


@query("average_purchase", """SELECT CustomerID, CASE WHEN n = 0 THEN 0.0 ELSE CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100.0 END AS AveragePurchase
    FROM (SELECT c.CustomerID, count(s.TransactionID) AS n,
          CAST(coalesce(sum(CAST(s.TransactionTotal * 100 AS DECIMAL(18,0))), 0) AS BIGINT) AS cents
          FROM @Customer c LEFT JOIN @SalesTransaction s ON s.CustomerID = c.CustomerID GROUP BY 1) x""")
def _(t, env):
    return C.average_purchase(t)


@query("campaign_response_rate", f"""SELECT CustomerID, CASE WHEN n = 0 THEN 0.0 ELSE CAST((20000 * done + n) // (2 * n) AS DOUBLE) / 100.0 END AS CampaignResponseRate
    FROM (SELECT c.CustomerID, count(r.ResponseID) AS n, {count_if('r.PurchaseCompleted')} AS done
          FROM @Customer c LEFT JOIN @CampaignResponse r ON r.CustomerID = c.CustomerID GROUP BY 1) x""")
def _(t, env):
    return C.campaign_response_rate(t)


@query("days_since_last_purchase", f"""SELECT c.CustomerID, {days('max(s.TransactionDate)', SALES_SQL)} AS DaysSinceLastPurchase
    FROM @Customer c LEFT JOIN @SalesTransaction s ON s.CustomerID = c.CustomerID GROUP BY 1""")
def _(t, env):
    return C.days_since_last_purchase(t, as_of=SALES_AS_OF)


# -- named datasets ---------------------------------------------------------------


@query("customer_analytics", "SELECT * FROM @Analytics")
def _(t, env):
    return V.customer_analytics(t, as_of=ANALYTICS_AS_OF)


@query("campaign_performance", "SELECT * FROM @Performance")
def _(t, env):
    return V.campaign_performance(t)


@query("sales_performance", "SELECT * FROM @Sales")
def _(t, env):
    return V.sales_performance(t)


@query("customer_ltv", "SELECT * FROM @Ltv")
def _(t, env):
    return V.customer_ltv(t, as_of=ANALYTICS_AS_OF)


@query("prediction_results", "SELECT * FROM @Results")
def _(t, env):
    return V.prediction_results(t)


@query("customer_metrics", "SELECT * FROM @Analytics")
def _(t, env):
    return V.customer_metrics(t, as_of=ANALYTICS_AS_OF)


# The key is the feature of these two and of the campaign queries below.
KEY = 7


@query("customer_metrics_of_key", f"SELECT * FROM @Analytics WHERE CustomerID = {KEY}")
def _(t, env):
    return V.customer_metrics(t, customer_id=KEY, as_of=ANALYTICS_AS_OF)


@query("campaign_summary_of_key", f"SELECT * FROM @Performance WHERE CampaignID = {KEY}")
def _(t, env):
    return V.campaign_summary(t, campaign_id=KEY)


@query("prediction_dataset", "SELECT * FROM @Analytics")
def _(t, env):
    return V.prediction_dataset(t, as_of=ANALYTICS_AS_OF)


@query("campaign_summary", "SELECT * FROM @Performance ORDER BY TotalRevenueGenerated DESC, CampaignID")
def _(t, env):
    return V.campaign_summary(t)


_EXECUTION = """ExecutionID, ExecutionDate, Algorithm, CAST(Accuracy AS DOUBLE) AS Accuracy, CAST(Precision_ AS DOUBLE) AS Precision_,
    CAST(Recall AS DOUBLE) AS Recall, CAST(F1Score AS DOUBLE) AS F1Score, CAST(ExecutionDurationSeconds AS DOUBLE) AS ExecutionDurationSeconds"""


@query("model_history", f"SELECT {_EXECUTION} FROM @ModelExecution ORDER BY ExecutionDate DESC, ExecutionID DESC")
def _(t, env):
    return V.model_history(t)


# -- business questions -------------------------------------------------------------

_TOP_CUSTOMERS = f"""SELECT c.CustomerID, c.FirstName, c.LastName, {money('s.TransactionTotal')} AS TotalRevenue,
    rank() OVER (ORDER BY {money('s.TransactionTotal')} DESC) AS RevenueRank
    FROM @Customer c JOIN @SalesTransaction s ON s.CustomerID = c.CustomerID GROUP BY 1, 2, 3
    ORDER BY TotalRevenue DESC, c.CustomerID LIMIT 20"""


@query("bq1_top_customers", _TOP_CUSTOMERS)
def _(t, env):
    return B.top_customers(t)


@query("bq2_best_campaign", f"""SELECT mc.CampaignID, mc.CampaignName, {pct(count_if('r.PurchaseCompleted'), 'count(*)')} AS ResponseRatePct
    FROM @MarketingCampaign mc JOIN @CampaignResponse r ON r.CampaignID = mc.CampaignID GROUP BY 1, 2
    ORDER BY ResponseRatePct DESC, mc.CampaignID LIMIT 1""")
def _(t, env):
    return B.best_campaign(t)


_PROFIT = "CAST(sum(CAST(i.Quantity * (p.UnitPrice - p.UnitCost) AS DECIMAL(18,2))) AS DOUBLE)"


@query("bq3_product_profit", f"""SELECT p.ProductID, p.ProductName, CAST(sum(i.Quantity) AS BIGINT) AS UnitsSold, {_PROFIT} AS TotalProfit,
    rank() OVER (ORDER BY {_PROFIT} DESC) AS ProfitRank FROM @Product p JOIN @SalesTransactionItem i ON i.ProductID = p.ProductID
    GROUP BY 1, 2 ORDER BY TotalProfit DESC, p.ProductID LIMIT 20""")
def _(t, env):
    return B.product_profit(t)


@query("bq4_store_month", f"""SELECT StoreID, StoreName, Yr, Mo, MonthlyRevenue, rank() OVER (ORDER BY MonthlyRevenue DESC) AS RevenueRank
    FROM (SELECT st.StoreID, st.StoreName, year(s.TransactionDate) AS Yr, month(s.TransactionDate) AS Mo, {money('s.TransactionTotal')} AS MonthlyRevenue
          FROM @SalesTransaction s JOIN @Store st ON st.StoreID = s.StoreID GROUP BY 1, 2, 3, 4) x
    ORDER BY MonthlyRevenue DESC, StoreID, Yr, Mo LIMIT 10""")
def _(t, env):
    return B.store_month(t)


@query("bq5_loyalty_spend", f"""SELECT ll.LevelName, {ratio('CAST(sum(t.spend) AS DOUBLE)', 'count(*)')} AS AvgSpendPerCustomer, count(*) AS CustomerCount
    FROM @LoyaltyMembership m JOIN @LoyaltyLevel ll ON ll.LoyaltyLevelID = m.LoyaltyLevelID
    JOIN (SELECT c.CustomerID, coalesce(sum(s.TransactionTotal), 0) AS spend FROM @Customer c
          LEFT JOIN @SalesTransaction s ON s.CustomerID = c.CustomerID GROUP BY 1) t ON t.CustomerID = m.CustomerID
    GROUP BY 1 ORDER BY AvgSpendPerCustomer DESC, ll.LevelName""")
def _(t, env):
    return B.loyalty_spend(t)


@query("bq6_lapsed_customers", f"""SELECT c.CustomerID, c.FirstName, c.LastName, l.LastTxnDate, {days('l.LastTxnDate', SALES_SQL)} AS DaysSinceLastPurchase
    FROM @Customer c LEFT JOIN (SELECT CustomerID, max(TransactionDate) AS LastTxnDate FROM @SalesTransaction GROUP BY 1) l
    ON l.CustomerID = c.CustomerID WHERE l.LastTxnDate IS NULL OR l.LastTxnDate < {SALES_SQL} - INTERVAL 6 MONTH
    ORDER BY l.LastTxnDate NULLS FIRST, c.CustomerID""")
def _(t, env):
    return B.lapsed_customers(t, as_of=SALES_AS_OF)


@query("bq7_campaign_roi", f"""SELECT CampaignID, CampaignName, Revenue, Revenue * pct / 100.0 AS EstimatedDiscountCost,
    (Revenue - Revenue * pct / 100.0) / nullif(Revenue * pct / 100.0, 0.0) AS ROI
    FROM (SELECT mc.CampaignID, mc.CampaignName, CAST(mc.DiscountPercent AS DOUBLE) AS pct, {money('r.PurchaseAmount')} AS Revenue
          FROM @MarketingCampaign mc JOIN @CampaignResponse r ON r.CampaignID = mc.CampaignID AND r.PurchaseCompleted GROUP BY 1, 2, 3) x
    ORDER BY ROI DESC NULLS LAST, CampaignID""")
def _(t, env):
    return B.campaign_roi(t)


# -- measures -------------------------------------------------------------------------


@query("m_total_revenue", f"SELECT {money('TransactionTotal')} AS TotalRevenue FROM @SalesTransaction")
def _(t, env):
    return D.total_revenue(t)


@query("m_avg_purchase", f"SELECT {ratio(money('TransactionTotal'), 'count(TransactionTotal)')} AS AveragePurchaseValue FROM @SalesTransaction")
def _(t, env):
    return D.average_purchase_value(t)


@query("m_response_rate", f"SELECT {ratio(count_if('PurchaseCompleted'), 'count(*)')} AS ResponseRate FROM @CampaignResponse")
def _(t, env):
    return D.response_rate(t)


@query("m_avg_discount", f"SELECT {ratio(money('Discount', 4), 'count(Discount)')} AS AverageDiscount FROM @SalesTransactionItem")
def _(t, env):
    return D.average_discount(t)


_YES = "PredictionResult = 'Yes'"


@query("m_predicted_responders", f"SELECT {count_if(_YES)} AS PredictedResponders FROM @CustomerPrediction")
def _(t, env):
    return D.predicted_responders(t)


@query("m_prediction_accuracy", """SELECT CAST(Accuracy AS DOUBLE) AS PredictionAccuracy FROM @ModelExecution
    ORDER BY ExecutionDate DESC, ExecutionID DESC LIMIT 1""")
def _(t, env):
    return D.prediction_accuracy(t)


@query("m_clv", """SELECT CAST(sum(CAST(s.TransactionTotal AS DECIMAL(18,2))) AS DOUBLE) AS TotalCLV
    FROM @Customer c JOIN @SalesTransaction s ON s.CustomerID = c.CustomerID""")
def _(t, env):
    return D.total_clv(t)


# -- dashboards -----------------------------------------------------------------------


@query("d1_kpis", f"""SELECT (SELECT count(*) FROM @Customer) AS TotalCustomers,
    (SELECT count(*) FROM @Customer WHERE CustomerStatus = 'Active') AS ActiveCustomers,
    (SELECT {money('TransactionTotal')} FROM @SalesTransaction) AS TotalSales,
    (SELECT {ratio(money('TransactionTotal'), 'count(*)')} FROM @SalesTransaction) AS AveragePurchaseValue,
    (SELECT count(*) FROM @MarketingCampaign) AS TotalCampaigns,
    (SELECT {pct(count_if('PurchaseCompleted'), 'count(*)')} FROM @CampaignResponse) AS CampaignResponseRate,
    (SELECT CAST(Accuracy AS DOUBLE) FROM @ModelExecution ORDER BY ExecutionDate DESC, ExecutionID DESC LIMIT 1) AS PredictionAccuracy,
    (SELECT max(GeneratedDate) FROM @AIReport) AS LastReportDate""")
def _(t, env):
    return D.kpis(t)


@query("d1_monthly_sales", f"SELECT strftime(TransactionDate, '%Y-%m') AS SalesMonth, {money('TransactionTotal')} AS TotalSales FROM @SalesTransaction GROUP BY 1")
def _(t, env):
    return D.monthly_sales(t)


@query("d1_customers_by_province", "SELECT Province, count(*) AS RecordCount FROM @Customer GROUP BY 1")
def _(t, env):
    return D.customers_by_province(t)


@query("d1_response_trend", f"SELECT strftime(ResponseDate, '%Y-%m') AS ResponseMonth, {pct(count_if('PurchaseCompleted'), 'count(*)')} AS ResponseRatePct FROM @CampaignResponse GROUP BY 1")
def _(t, env):
    return D.response_trend(t)


@query("d1_latest_report_text", """SELECT AIReportID, GeneratedDate, ReportText FROM @AIReport WHERE ReportType = 'Executive Summary'
    ORDER BY GeneratedDate DESC, AIReportID DESC LIMIT 1""")
def _(t, env):
    return D.latest_report_text(t)


@query("d2_age_histogram", f"SELECT floor({age('DateOfBirth')} / 10.0) * 10.0 AS BinStart, count(*) AS RecordCount FROM @Customer GROUP BY 1")
def _(t, env):
    return D.age_histogram(t, as_of=ANALYTICS_AS_OF)


_RECENCY = f"""SELECT c.CustomerID, {days('max(s.TransactionDate)', SALES_SQL)} AS recency FROM @Customer c
    LEFT JOIN @SalesTransaction s ON s.CustomerID = c.CustomerID GROUP BY 1"""


@query("d2_recency_histogram", f"SELECT floor(recency / 30.0) * 30.0 AS BinStart, count(*) AS RecordCount FROM ({_RECENCY}) x GROUP BY 1")
def _(t, env):
    return D.recency_histogram(t, as_of=SALES_AS_OF)


@query("d2_loyalty_distribution", "SELECT LoyaltyLevel, count(*) AS RecordCount FROM @Analytics GROUP BY 1")
def _(t, env):
    return D.loyalty_distribution(t)


@query("d2_top_clv", "SELECT * FROM @Ltv ORDER BY CustomerLifetimeValue DESC, CustomerID LIMIT 10")
def _(t, env):
    return D.top_clv(t, as_of=ANALYTICS_AS_OF)


@query("d2_avg_purchase", """SELECT LoyaltyLevel, grouping(LoyaltyLevel) = 1 AS IsOverall, round(avg(AveragePurchaseValue), 4) AS AvgPurchaseValue
    FROM @Analytics GROUP BY ROLLUP (LoyaltyLevel)""")
def _(t, env):
    # sums of doubles depend on row order in the last digits
    return D.average_purchase_by_level(t).withColumn("AvgPurchaseValue", F.round("AvgPurchaseValue", 4))


@query("d2_purchase_frequency", "SELECT NumTransactions, count(*) AS RecordCount FROM @Analytics GROUP BY 1")
def _(t, env):
    return D.purchase_frequency(t)


@query("d3_revenue_by_store", f"SELECT StoreID, StoreName, Province, {money('LineTotal', 4)} AS Revenue FROM @SoldLines GROUP BY 1, 2, 3")
def _(t, env):
    return D.revenue_by_store(t)


@query("d3_revenue_by_category", f"SELECT CategoryID, CategoryName, {money('LineTotal', 4)} AS Revenue FROM @SoldLines GROUP BY 1, 2")
def _(t, env):
    return D.revenue_by_category(t)


@query("d3_monthly_sales", f"SELECT SalesYear, SalesMonth, {money('LineTotal', 4)} AS Revenue FROM @SoldLines GROUP BY 1, 2")
def _(t, env):
    return D.monthly_line_sales(t)


_BY_PRODUCT = f"""SELECT p.ProductID, p.ProductName, {money('i.LineTotal', 4)} AS Revenue FROM @SalesTransactionItem i
    JOIN @Product p ON p.ProductID = i.ProductID GROUP BY 1, 2 ORDER BY Revenue DESC, p.ProductID LIMIT 10"""


@query("d3_revenue_by_product", _BY_PRODUCT)
def _(t, env):
    return D.revenue_by_product(t)


@query("d3_avg_transaction", f"SELECT {ratio(money('TransactionTotal'), 'count(TransactionTotal)')} AS AveragePurchaseValue FROM @SalesTransaction")
def _(t, env):
    return D.average_purchase_value(t)


@query("d4_campaign_funnel", f"""SELECT mc.CampaignID, mc.CampaignName, count(r.ResponseID) AS Contacted, {count_if('r.EmailOpened')} AS Opened,
    {count_if('r.CouponUsed')} AS CouponUsed, {count_if('r.PurchaseCompleted')} AS Purchased
    FROM @MarketingCampaign mc LEFT JOIN @CampaignResponse r ON r.CampaignID = mc.CampaignID GROUP BY 1, 2""")
def _(t, env):
    return D.campaign_funnel(t)


@query("d5_confusion_matrix", """SELECT ActualPurchaseCompleted AS Actual, PredictionResult AS Predicted, count(*) AS RecordCount
    FROM @Results WHERE PredictionCorrect IS NOT NULL GROUP BY 1, 2""")
def _(t, env):
    return D.confusion_matrix(t)


@query("d5_metrics", """SELECT ExecutionID, CAST(Accuracy AS DOUBLE) AS Accuracy, CAST(Precision_ AS DOUBLE) AS Precision,
    CAST(Recall AS DOUBLE) AS Recall, CAST(F1Score AS DOUBLE) AS F1Score FROM @ModelExecution ORDER BY ExecutionDate DESC, ExecutionID DESC LIMIT 1""")
def _(t, env):
    return D.model_metrics(t)


@query("d5_probability_histogram", """SELECT least(CAST(floor(PredictionProbability * 10) AS BIGINT), 9) AS Bin, count(*) AS RecordCount
    FROM @CustomerPrediction GROUP BY 1""")
def _(t, env):
    return D.probability_histogram(t)


@query("d6_report_index", """SELECT AIReportID, ReportType, CAST(CampaignID AS DOUBLE) AS CampaignID, GeneratedDate, PromptVersion, Approved FROM @AIReport
    ORDER BY GeneratedDate DESC, AIReportID DESC""")
def _(t, env):
    return optional_numbers(D.report_index(t), "CampaignID")


# -- spec rows that stand alone ---------------------------------------------------------

_SLICE = "Province = 'ASIA' AND TransactionDate >= TIMESTAMP '1998-01-01 00:00:00' AND TransactionDate < TIMESTAMP '1999-01-01 00:00:00'"


@query("bi_slicers", f"""SELECT CustomerID, {money('TransactionTotal')} AS TotalSales FROM (SELECT s.CustomerID, s.TransactionDate, s.TransactionTotal, c.Province
    FROM @SalesTransaction s JOIN @Customer c ON c.CustomerID = s.CustomerID) x WHERE {_SLICE} GROUP BY 1""")
def _(t, env):
    from cartwheel.functions import expr as E
    from cartwheel.operators.select import slice_rows

    sales = t["SalesTransaction"].join(t["Customer"].select("CustomerID", "Province"), "CustomerID")
    sliced = slice_rows(sales, province="ASIA", start="1998-01-01", end="1999-01-01", date_column="TransactionDate")
    return sliced.groupBy("CustomerID").agg(E.money_sum(F.col("TransactionTotal")).alias("TotalSales"))


_DRILL = """SELECT r.CampaignID, r.ResponseID, r.CustomerID, c.FirstName, c.LastName, c.Province, r.EmailOpened, r.CouponUsed,
    r.PurchaseCompleted, CAST(r.PurchaseAmount AS DOUBLE) AS PurchaseAmount, r.ResponseDate
    FROM @CampaignResponse r JOIN @Customer c ON c.CustomerID = r.CustomerID"""


@query("campaign_drillthrough", _DRILL)
def _(t, env):
    return D.campaign_drillthrough(t)


@query("campaign_drillthrough_of_key", f"{_DRILL} WHERE r.CampaignID = {KEY}")
def _(t, env):
    return D.campaign_drillthrough(t, campaign_id=KEY)


@query("campaign_ranking", """SELECT rank() OVER (ORDER BY TotalRevenueGenerated DESC) AS RevenueRank, CampaignID, CampaignName, ChannelName,
    TotalRevenueGenerated, PurchaseCompletionRate FROM @Performance""")
def _(t, env):
    return D.campaign_ranking(t)


@query("topn_entities", f"""SELECT * FROM (SELECT 'customer' AS Entity, CustomerID AS EntityID, CustomerLifetimeValue AS Amount FROM @Ltv
    ORDER BY Amount DESC, EntityID LIMIT 10) a UNION ALL SELECT 'product', ProductID, Revenue FROM ({_BY_PRODUCT}) b""")
def _(t, env):
    customers = D.top_clv(t, as_of=ANALYTICS_AS_OF).select(
        F.lit("customer").alias("Entity"), F.col("CustomerID").alias("EntityID"), F.col("CustomerLifetimeValue").alias("Amount")
    )
    products = D.revenue_by_product(t).select(
        F.lit("product").alias("Entity"), F.col("ProductID").alias("EntityID"), F.col("Revenue").alias("Amount")
    )
    return customers.unionByName(products)


@query("agg_sales_rollup", f"""SELECT CAST(l.SalesYear AS DOUBLE) AS SalesYear, CAST(l.StoreID AS DOUBLE) AS StoreID, CAST(l.CategoryID AS DOUBLE) AS CategoryID, grouping_id(l.SalesYear, l.StoreID, l.CategoryID) AS GroupingLevel,
    {money('LineTotal', 4)} AS Revenue, CAST(sum(Quantity) AS BIGINT) AS UnitsSold, count(DISTINCT TransactionID) AS TransactionCount
    FROM @SoldLines l GROUP BY ROLLUP (l.SalesYear, l.StoreID, l.CategoryID)""")
def _(t, env):
    return optional_numbers(V.sales_rollup(t), "SalesYear", "StoreID", "CategoryID")


@query("agg_value_histogram", """SELECT floor(CAST(TransactionTotal AS DOUBLE) / 10000.0) * 10000.0 AS BinStart, count(*) AS RecordCount
    FROM @SalesTransaction GROUP BY 1""")
def _(t, env):
    from cartwheel.operators.aggregate import histogram

    return histogram(t["SalesTransaction"], "TransactionTotal", 10000)
