"""One small query per projection, predicate, join, aggregate, window, sort,
set operation and scalar function."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators import aggregate as A
from cartwheel.operators import ordering as O
from cartwheel.operators import quality as Q
from cartwheel.operators import select as P
from cartwheel.operators.dimensions import distinct_names
from cartwheel.operators.latest import latest_per_key, latest_row
from cartwheel.plans import learning as L
from cartwheel.plans import views as V
from cartwheel.sources.bindings import ANALYTICS_AS_OF, SALES_AS_OF
from registry.canon import SALES_AS_OF as SALES_SQL
from registry.canon import AS_OF, age, count_if, days, dollars_text, money, pct, percent_text, ratio
from registry.core import optional_numbers, query

c = F.col

# -- projections, predicates, conditionals ------------------------------------------


@query("proj_computed", "SELECT TransactionItemID, ProductID, CAST(Quantity * UnitPrice AS DOUBLE) AS GrossTotal, CAST(LineTotal AS DOUBLE) AS NetTotal FROM @SalesTransactionItem")
def _(t, env):
    return t["SalesTransactionItem"].select(
        "TransactionItemID", "ProductID", (c("Quantity") * c("UnitPrice")).alias("GrossTotal"), c("LineTotal").alias("NetTotal")
    )


@query("proj_star", "SELECT * FROM @Ltv")
def _(t, env):
    return V.customer_ltv(t, as_of=ANALYTICS_AS_OF).select("*")


_TXN = "TransactionID, CustomerID, CAST(TransactionTotal AS DOUBLE) AS TransactionTotal"


@query("filter_optional_key", f"SELECT 'all' AS Scope, count(*) AS RecordCount FROM @SalesTransaction UNION ALL SELECT 'one', count(*) FROM @SalesTransaction WHERE CustomerID = 7")
def _(t, env):
    def size(scope, key):
        rows = P.only_key(t["SalesTransaction"], "CustomerID", key)
        return rows.agg(F.count("*").alias("RecordCount")).select(F.lit(scope).alias("Scope"), "RecordCount")

    return size("all", None).unionByName(size("one", 7))


@query("filter_equality", "SELECT CustomerID, CustomerStatus FROM @Customer WHERE CustomerStatus = 'Active'")
def _(t, env):
    return P.equal_to(t["Customer"], "CustomerStatus", "Active").select("CustomerID", "CustomerStatus")


_LAST = "SELECT CustomerID, max(TransactionDate) AS LastTxnDate FROM @SalesTransaction GROUP BY 1"


@query("filter_isnull_or_before", f"""SELECT c.CustomerID, l.LastTxnDate FROM @Customer c LEFT JOIN ({_LAST}) l ON l.CustomerID = c.CustomerID
    WHERE l.LastTxnDate IS NULL OR l.LastTxnDate < TIMESTAMP '2001-01-01 00:00:00'""")
def _(t, env):
    last = t["SalesTransaction"].groupBy("CustomerID").agg(F.max("TransactionDate").alias("LastTxnDate"))
    rows = t["Customer"].select("CustomerID").join(last, "CustomerID", "left")
    return P.null_or_before(rows, "LastTxnDate", F.lit("2001-01-01").cast("timestamp_ntz"))


@query("filter_not_between", "SELECT CustomerID, Age FROM @Customer WHERE Age NOT BETWEEN 18 AND 65")
def _(t, env):
    return P.out_of_range(t["Customer"], "Age", 18, 65).select("CustomerID", "Age")


@query("filter_in_list", "SELECT CustomerID, CustomerStatus FROM @Customer WHERE CustomerStatus IN ('Inactive', 'Suspended')")
def _(t, env):
    return P.in_list(t["Customer"], "CustomerStatus", ["Inactive", "Suspended"]).select("CustomerID", "CustomerStatus")


@query("filter_ge_median", f"SELECT {_TXN} FROM @SalesTransaction WHERE TransactionTotal >= (SELECT quantile_cont(CAST(TransactionTotal AS DOUBLE), 0.5) FROM @SalesTransaction)")
def _(t, env):
    from cartwheel.plans.reports import at_least_median

    sales = t["SalesTransaction"].select("TransactionID", "CustomerID", c("TransactionTotal").cast("double"))
    return at_least_median(sales, "TransactionTotal")


_SPENT = f"SELECT CustomerID, count(*) AS n, {money('TransactionTotal')} AS total FROM @SalesTransaction GROUP BY 1"


@query("case_zero_guard", f"""SELECT c.CustomerID, CASE WHEN coalesce(r.n, 0) = 0 THEN 0.0 ELSE r.total / r.n END AS AvgResponseAmount
    FROM @Customer c LEFT JOIN (SELECT CustomerID, count(*) AS n, {money('PurchaseAmount')} AS total FROM @CampaignResponse GROUP BY 1) r
    ON r.CustomerID = c.CustomerID""")
def _(t, env):
    facts = t["CampaignResponse"].groupBy("CustomerID").agg(F.count("*").alias("n"), E.money_sum(c("PurchaseAmount")).alias("total"))
    rows = t["Customer"].select("CustomerID").join(facts, "CustomerID", "left")
    return rows.select("CustomerID", E.zero_f(E.ratio(c("total"), c("n"))).alias("AvgResponseAmount"))


@query("case_tristate_correct", "SELECT CustomerID, PredictionResult, ActualPurchaseCompleted, PredictionCorrect FROM @Results")
def _(t, env):
    return V.prediction_results(t).select("CustomerID", "PredictionResult", "ActualPurchaseCompleted", "PredictionCorrect")


@query("threshold_label", "SELECT PredictionID, CAST(PredictionProbability AS DOUBLE) AS Probability, CASE WHEN PredictionProbability >= 0.5 THEN 'Yes' ELSE 'No' END AS Result FROM @CustomerPrediction")
def _(t, env):
    p = c("PredictionProbability").cast("double")
    return t["CustomerPrediction"].select("PredictionID", p.alias("Probability"), E.yes_no(p).alias("Result"))


# -- joins ------------------------------------------------------------------------------


@query("join_inner_equi", "SELECT s.TransactionID, c.CustomerID, c.LastName FROM @SalesTransaction s JOIN @Customer c ON c.CustomerID = s.CustomerID")
def _(t, env):
    return t["SalesTransaction"].select("TransactionID", "CustomerID").join(t["Customer"].select("CustomerID", "LastName"), "CustomerID")


@query("join_star_5way", "SELECT TransactionID, StoreID, StoreName, CategoryID, CategoryName, CAST(LineTotal AS DOUBLE) AS LineTotal FROM @SoldLines")
def _(t, env):
    return V.sales_lines(t).select("TransactionID", "StoreID", "StoreName", "CategoryID", "CategoryName", "LineTotal")


@query("join_left_outer", f"SELECT c.CustomerID, t.n AS NumTransactions FROM @Customer c LEFT JOIN ({_SPENT}) t ON t.CustomerID = c.CustomerID")
def _(t, env):
    facts = t["SalesTransaction"].groupBy("CustomerID").agg(F.count("*").alias("NumTransactions"))
    return t["Customer"].select("CustomerID").join(facts, "CustomerID", "left")


@query("join_left_latest", "SELECT c.CustomerID, CAST(r.ResponseID AS DOUBLE) AS ResponseID, r.ResponseDate FROM @Customer c LEFT JOIN @LatestResponse r ON r.CustomerID = c.CustomerID")
def _(t, env):
    newest = latest_per_key(t["CampaignResponse"].select("CustomerID", "ResponseID", "ResponseDate"), "CustomerID", "ResponseDate", "ResponseID")
    return optional_numbers(t["Customer"].select("CustomerID").join(newest, "CustomerID", "left"), "ResponseID")


@query("join_inner_on_predicate", """SELECT mc.CampaignID, r.ResponseID, CAST(r.PurchaseAmount AS DOUBLE) AS PurchaseAmount
    FROM @MarketingCampaign mc JOIN @CampaignResponse r ON r.CampaignID = mc.CampaignID AND r.PurchaseCompleted""")
def _(t, env):
    bought = t["CampaignResponse"].where("PurchaseCompleted").select("CampaignID", "ResponseID", "PurchaseAmount")
    return t["MarketingCampaign"].select("CampaignID").join(bought, "CampaignID")


@query("join_anti", "SELECT CampaignID FROM @MarketingCampaign mc WHERE NOT EXISTS (SELECT 1 FROM @CampaignResponse r WHERE r.CampaignID = mc.CampaignID)")
def _(t, env):
    return Q.unmatched(t["MarketingCampaign"], t["CampaignResponse"], "CampaignID")


@query("join_orphan_check", "SELECT count(*) AS OrphanCount FROM @SalesTransaction s LEFT JOIN @LoyaltyMembership m ON m.CustomerID = s.CustomerID WHERE m.CustomerID IS NULL")
def _(t, env):
    return Q.orphans(t, [("SalesTransaction", "CustomerID", "LoyaltyMembership", "CustomerID")]).select("OrphanCount")


@query("join_lateral_agg", f"SELECT m.CustomerID, coalesce({money('s.TransactionTotal')}, 0.0) AS TotalSpend FROM @LoyaltyMembership m LEFT JOIN @SalesTransaction s ON s.CustomerID = m.CustomerID GROUP BY 1")
def _(t, env):
    spend = t["SalesTransaction"].groupBy("CustomerID").agg(E.money_sum(c("TransactionTotal")).alias("spend"))
    return t["LoyaltyMembership"].select("CustomerID").join(spend, "CustomerID", "left").select(
        "CustomerID", E.zero_f(c("spend")).alias("TotalSpend")
    )


@query("join_fk_relations", """SELECT s.TransactionID, c.City AS CustomerCity, st.City AS StoreCity FROM @SalesTransaction s
    JOIN @Customer c ON c.CustomerID = s.CustomerID JOIN @Store st ON st.StoreID = s.StoreID""")
def _(t, env):
    # both sides have a City; only declared keys join
    customers = t["Customer"].select("CustomerID", c("City").alias("CustomerCity"))
    stores = t["Store"].select("StoreID", c("City").alias("StoreCity"))
    return t["SalesTransaction"].join(customers, "CustomerID").join(stores, "StoreID").select("TransactionID", "CustomerCity", "StoreCity")


# -- aggregates -------------------------------------------------------------------------


@query("agg_count_star", "SELECT CustomerID, count(*) AS RecordCount FROM @SalesTransaction GROUP BY 1")
def _(t, env):
    return A.distribution(t["SalesTransaction"], "CustomerID")


@query("agg_count_col", "SELECT mc.CampaignID, count(r.ResponseID) AS Contacted FROM @MarketingCampaign mc LEFT JOIN @CampaignResponse r ON r.CampaignID = mc.CampaignID GROUP BY 1")
def _(t, env):
    counts = t["CampaignResponse"].groupBy("CampaignID").agg(F.count("ResponseID").alias("n"))
    return t["MarketingCampaign"].select("CampaignID").join(counts, "CampaignID", "left").select("CampaignID", E.zero(c("n")).alias("Contacted"))


@query("agg_sum", f"SELECT ProductID, {money('LineTotal', 4)} AS Revenue FROM @SalesTransactionItem GROUP BY 1")
def _(t, env):
    return t["SalesTransactionItem"].groupBy("ProductID").agg(E.money_sum(c("LineTotal"), 4).alias("Revenue"))


@query("agg_avg", f"SELECT ProductID, {ratio(money('Discount', 4), 'count(Discount)')} AS AvgDiscount FROM @SalesTransactionItem GROUP BY 1")
def _(t, env):
    # avg as exact sum over count
    return t["SalesTransactionItem"].groupBy("ProductID").agg(
        E.ratio(E.money_sum(c("Discount"), 4), F.count("Discount")).alias("AvgDiscount")
    )


@query("agg_max", _LAST)
def _(t, env):
    return t["SalesTransaction"].groupBy("CustomerID").agg(F.max("TransactionDate").alias("LastTxnDate"))


@query("agg_count_distinct", "SELECT s.CustomerID, count(DISTINCT i.ProductID) AS NumProducts FROM @SalesTransaction s JOIN @SalesTransactionItem i ON i.TransactionID = s.TransactionID GROUP BY 1")
def _(t, env):
    lines = t["SalesTransaction"].select("TransactionID", "CustomerID").join(t["SalesTransactionItem"].select("TransactionID", "ProductID"), "TransactionID")
    return lines.groupBy("CustomerID").agg(F.count_distinct("ProductID").alias("NumProducts"))


@query("agg_conditional_sum", f"SELECT CampaignID, {count_if('EmailOpened')} AS Opened, {count_if('PurchaseCompleted')} AS Completed FROM @CampaignResponse GROUP BY 1")
def _(t, env):
    return t["CampaignResponse"].groupBy("CampaignID").agg(F.count_if("EmailOpened").alias("Opened"), F.count_if("PurchaseCompleted").alias("Completed"))


@query("agg_rate_pct", f"SELECT CustomerID, {pct(count_if('PurchaseCompleted'), 'count(*)')} AS ResponseRatePct FROM @CampaignResponse GROUP BY 1")
def _(t, env):
    return t["CampaignResponse"].groupBy("CustomerID").agg(A.rate_pct("PurchaseCompleted").alias("ResponseRatePct"))


@query("agg_avg_nonzero", f"SELECT CustomerID, coalesce({ratio(money('PurchaseAmount'), 'count(nullif(PurchaseAmount, 0))')}, 0.0) AS AvgAmount FROM @CampaignResponse GROUP BY 1")
def _(t, env):
    paid = F.nullif(c("PurchaseAmount"), F.lit(0).cast("decimal(10,2)"))
    return t["CampaignResponse"].groupBy("CustomerID").agg(
        E.zero_f(E.ratio(E.money_sum(c("PurchaseAmount")), F.count(paid))).alias("AvgAmount")
    )


@query("agg_sum_product", "SELECT i.ProductID, CAST(sum(CAST(i.Quantity * (p.UnitPrice - p.UnitCost) AS DECIMAL(18,2))) AS DOUBLE) AS Profit FROM @SalesTransactionItem i JOIN @Product p ON p.ProductID = i.ProductID GROUP BY 1")
def _(t, env):
    units = t["SalesTransactionItem"].groupBy("ProductID").agg(F.sum("Quantity").alias("units"))
    profit = (c("units") * (c("UnitPrice") - c("UnitCost"))).cast("decimal(28,2)").cast("double")
    return units.join(t["Product"], "ProductID").select("ProductID", profit.alias("Profit"))


@query("agg_group_by_expr", f"SELECT year(TransactionDate) AS Yr, month(TransactionDate) AS Mo, {money('TransactionTotal')} AS Revenue FROM @SalesTransaction GROUP BY 1, 2")
def _(t, env):
    return t["SalesTransaction"].groupBy(F.year("TransactionDate").alias("Yr"), F.month("TransactionDate").alias("Mo")).agg(
        E.money_sum(c("TransactionTotal")).alias("Revenue")
    )


@query("agg_having_dup", "SELECT TransactionItemID, count(*) AS Occurrences FROM @SalesTransactionItem GROUP BY 1 HAVING count(*) > 1")
def _(t, env):
    return Q.duplicate_keys(t["SalesTransactionItem"], "TransactionItemID")


@query("agg_global", f"SELECT count(*) AS Responses, {count_if('PurchaseCompleted')} AS Completed, {money('PurchaseAmount')} AS Revenue FROM @CampaignResponse")
def _(t, env):
    return t["CampaignResponse"].agg(
        F.count("*").alias("Responses"), F.count_if("PurchaseCompleted").alias("Completed"), E.money_sum(c("PurchaseAmount")).alias("Revenue")
    )


@query("agg_of_agg", f"""SELECT m.LoyaltyLevelID, {ratio('CAST(sum(t.spend) AS DOUBLE)', 'count(*)')} AS AvgSpend FROM @LoyaltyMembership m
    JOIN (SELECT CustomerID, sum(TransactionTotal) AS spend FROM @SalesTransaction GROUP BY 1) t ON t.CustomerID = m.CustomerID GROUP BY 1""")
def _(t, env):
    spend = t["SalesTransaction"].groupBy("CustomerID").agg(F.sum("TransactionTotal").alias("spend"))
    members = t["LoyaltyMembership"].select("CustomerID", "LoyaltyLevelID").join(spend, "CustomerID")
    return members.groupBy("LoyaltyLevelID").agg(E.ratio(F.sum("spend").cast("double"), F.count("*")).alias("AvgSpend"))


_MEAN = ratio("CAST(sum(CAST(PurchaseCompletionRate AS DECIMAL(28,12))) AS DOUBLE)", "count(PurchaseCompletionRate)")


@query("agg_mean_by_key_argmax", f"""SELECT ChannelName, round({_MEAN}, 6) AS MeanValue FROM @Performance GROUP BY 1
    ORDER BY {_MEAN} DESC NULLS LAST, ChannelName LIMIT 1""")
def _(t, env):
    best = A.best_key_by_mean(V.campaign_performance(t), "ChannelName", "PurchaseCompletionRate")
    return best.withColumn("MeanValue", F.round("MeanValue", 6))


@query("agg_median", "SELECT quantile_cont(CAST(LineTotal AS DOUBLE), 0.5) AS MedianLineTotal FROM @SalesTransactionItem")
def _(t, env):
    return O.median(t["SalesTransactionItem"], "LineTotal").select(c("q0").alias("MedianLineTotal"))


_REPORT = ["AIReportID", "ReportType", "CampaignID", "GeneratedDate", "ModelName", "PromptVersion", "ReportText", "Approved"]


@query("agg_null_counts", " UNION ALL ".join(
    f"SELECT 'AIReport' AS TableName, '{n}' AS RuleName, {count_if(f'{n} IS NULL')} AS Violations FROM @AIReport" for n in _REPORT))
def _(t, env):
    return Q.null_counts(t, {"AIReport": _REPORT})


@query("agg_dup_count", "SELECT count(*) - count(DISTINCT TransactionItemID) AS DuplicateCount FROM @SalesTransactionItem")
def _(t, env):
    return Q.duplicate_rows(t["SalesTransactionItem"], "TransactionItemID")


@query("agg_describe", " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, count({f}) AS count, round(avg({f}), 4) AS mean, round(stddev_samp({f}), 4) AS std, CAST(min({f}) AS DOUBLE) AS min,
    round(quantile_cont(CAST({f} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({f} AS DOUBLE), 0.5), 6) AS p50,
    round(quantile_cont(CAST({f} AS DOUBLE), 0.75), 6) AS p75, CAST(max({f}) AS DOUBLE) AS max FROM @Features""" for f in L.FEATURES))
def _(t, env):
    matrix = L.features(V.customer_analytics(t, as_of=ANALYTICS_AS_OF), for_training=False)
    table = O.describe(matrix, L.FEATURES)
    digits = {"mean": 4, "std": 4, "p25": 6, "p50": 6, "p75": 6}
    return table.select(*[F.round(n, digits[n]).alias(n) if n in digits else c(n) for n in table.columns])


# -- windows ----------------------------------------------------------------------------


@query("win_latest_response", "SELECT CustomerID, ResponseID, ResponseDate, PurchaseCompleted FROM @LatestResponse")
def _(t, env):
    rows = t["CampaignResponse"].select("CustomerID", "ResponseID", "ResponseDate", "PurchaseCompleted")
    return latest_per_key(rows, "CustomerID", "ResponseDate", "ResponseID")


@query("win_latest_prediction", "SELECT CustomerID, PredictionID, PredictionResult FROM @LatestPrediction")
def _(t, env):
    return latest_per_key(t["CustomerPrediction"], "CustomerID", "PredictionDate", "PredictionID").select("CustomerID", "PredictionID", "PredictionResult")


@query("win_rank_over_agg", f"SELECT CustomerID, total AS TotalRevenue, rank() OVER (ORDER BY total DESC) AS RevenueRank FROM ({_SPENT}) x ORDER BY total DESC, CustomerID LIMIT 20")
def _(t, env):
    totals = t["SalesTransaction"].groupBy("CustomerID").agg(E.money_sum(c("TransactionTotal")).alias("TotalRevenue"))
    return O.top_k_ranked(totals, 20, "TotalRevenue", "CustomerID", "RevenueRank")


_MONTHS = f"SELECT StoreID, year(TransactionDate) AS Yr, month(TransactionDate) AS Mo, {money('TransactionTotal')} AS MonthlyRevenue FROM @SalesTransaction GROUP BY 1, 2, 3"


@query("win_rank_global", f"SELECT *, rank() OVER (ORDER BY MonthlyRevenue DESC) AS RevenueRank FROM ({_MONTHS}) x")
def _(t, env):
    months = t["SalesTransaction"].groupBy("StoreID", F.year("TransactionDate").alias("Yr"), F.month("TransactionDate").alias("Mo")).agg(
        E.money_sum(c("TransactionTotal")).alias("MonthlyRevenue")
    )
    return O.global_rank(months, "MonthlyRevenue", "RevenueRank")


# -- sorts, limits ------------------------------------------------------------------------


@query("sort_result", f"SELECT {_TXN} FROM @SalesTransaction ORDER BY TransactionTotal DESC, TransactionID")
def _(t, env):
    return t["SalesTransaction"].select("TransactionID", "CustomerID", "TransactionTotal").orderBy(c("TransactionTotal").desc(), "TransactionID")


@query("topk", f"SELECT {_TXN} FROM @SalesTransaction ORDER BY 3 DESC, 1 LIMIT 20")
def _(t, env):
    rows = t["SalesTransaction"].select("TransactionID", "CustomerID", "TransactionTotal")
    return O.top_k(rows, 20, c("TransactionTotal").desc(), c("TransactionID").asc())


@query("argmax_row", "SELECT CampaignID, CampaignName, TotalRevenueGenerated FROM @Performance ORDER BY TotalRevenueGenerated DESC, CampaignID LIMIT 1")
def _(t, env):
    best = O.argmax_row(V.campaign_performance(t), "TotalRevenueGenerated", "CampaignID")
    return best.select("CampaignID", "CampaignName", "TotalRevenueGenerated")


@query("latest_row", "SELECT ResponseID, CustomerID, ResponseDate FROM @CampaignResponse ORDER BY ResponseDate DESC, ResponseID DESC LIMIT 1")
def _(t, env):
    return latest_row(t["CampaignResponse"], "ResponseDate", "ResponseID").select("ResponseID", "CustomerID", "ResponseDate")


# A preview is a limit by nature; the order makes it repeatable.
@query("head", "SELECT * FROM @Ltv ORDER BY CustomerID LIMIT 5")
def _(t, env):
    return O.top_k(V.customer_ltv(t, as_of=ANALYTICS_AS_OF), 5, c("CustomerID").asc())


# -- set operations -------------------------------------------------------------------------


@query("set_union_all", "SELECT CustomerID, 'sale' AS Kind FROM @SalesTransaction UNION ALL SELECT CustomerID, 'response' FROM @CampaignResponse")
def _(t, env):
    return Q.stack_rows([
        t["SalesTransaction"].select("CustomerID", F.lit("sale").alias("Kind")),
        t["CampaignResponse"].select("CustomerID", F.lit("response").alias("Kind")),
    ])


@query("set_distinct", "SELECT DISTINCT o_orderpriority AS MethodName FROM orders")
def _(t, env):
    staged = t["SalesTransaction"].join(t["PaymentMethod"], "PaymentMethodID")
    return distinct_names(staged, "MethodName").select(c("_name").alias("MethodName"))


@query("set_difference", "SELECT DISTINCT CustomerID FROM @SalesTransaction EXCEPT SELECT CustomerID FROM @CampaignResponse")
def _(t, env):
    return t["SalesTransaction"].select("CustomerID").subtract(t["CampaignResponse"].select("CustomerID"))


# -- scalar functions ---------------------------------------------------------------------------


@query("fn_coalesce", "SELECT AIReportID, coalesce(CampaignID, 0) AS CampaignID FROM @AIReport")
def _(t, env):
    return t["AIReport"].select("AIReportID", E.zero(c("CampaignID")).alias("CampaignID"))


@query("fn_nullif", "SELECT ResponseID, CAST(nullif(PurchaseAmount, 0) AS DOUBLE) AS PaidAmount FROM @CampaignResponse")
def _(t, env):
    return t["CampaignResponse"].select("ResponseID", F.nullif(c("PurchaseAmount"), F.lit(0).cast("decimal(10,2)")).alias("PaidAmount"))


@query("fn_cast_decimal", "SELECT TransactionItemID, ProductID, Quantity, CAST(CAST(LineTotal AS DECIMAL(12,2)) AS DOUBLE) AS LineTotal FROM @SalesTransactionItem")
def _(t, env):
    return t["SalesTransactionItem"].select("TransactionItemID", "ProductID", "Quantity", c("LineTotal").cast("decimal(12,2)"))


@query("fn_year_month_day", "SELECT CustomerID, year(DateOfBirth) AS y, month(DateOfBirth) AS m, day(DateOfBirth) AS d FROM @Customer")
def _(t, env):
    return t["Customer"].select("CustomerID", F.year("DateOfBirth").alias("y"), F.month("DateOfBirth").alias("m"), F.day("DateOfBirth").alias("d"))


@query("fn_datediff_day", f"SELECT ResponseID, {days('ResponseDate')} AS DaysAgo FROM @CampaignResponse")
def _(t, env):
    return t["CampaignResponse"].select("ResponseID", E.days_since(c("ResponseDate"), ANALYTICS_AS_OF).alias("DaysAgo"))


@query("fn_age_years", f"SELECT CustomerID, {age('DateOfBirth', SALES_SQL)} AS Age FROM @Customer")
def _(t, env):
    return t["Customer"].select("CustomerID", E.age_years(c("DateOfBirth"), SALES_AS_OF).alias("Age"))


@query("fn_dateadd_month", f"SELECT TransactionID, TransactionDate < {SALES_SQL} - INTERVAL 6 MONTH AS IsOld FROM @SalesTransaction")
def _(t, env):
    return t["SalesTransaction"].select("TransactionID", (c("TransactionDate") < E.months_before(SALES_AS_OF, 6)).alias("IsOld"))


@query("fn_now", f"""SELECT CustomerID, {AS_OF} AS Moment, date_diff('day', RegistrationDate, CAST({AS_OF} AS DATE)) AS DaysBefore, true AS IsPast FROM @Customer""")
def _(t, env):
    # a given moment; without one, the clock
    return t["Customer"].select(
        "CustomerID", E.now(ANALYTICS_AS_OF).alias("Moment"), F.datediff(E.now(ANALYTICS_AS_OF), "RegistrationDate").alias("DaysBefore"),
        (c("RegistrationDate").cast("timestamp_ntz") < E.now(None)).alias("IsPast"))


@query("fn_arith", "SELECT CampaignID, CAST(DiscountPercent AS DOUBLE) / 100.0 AS Fraction, 100.0 - CAST(DiscountPercent AS DOUBLE) AS Remainder FROM @MarketingCampaign")
def _(t, env):
    d = c("DiscountPercent").cast("double")
    return t["MarketingCampaign"].select("CampaignID", (d / 100.0).alias("Fraction"), (F.lit(100.0) - d).alias("Remainder"))


@query("fn_parse_cast", "SELECT CustomerID, CAST(DateOfBirth AS VARCHAR) AS DateOfBirth, CAST(substr(LoyaltyNumber, 3) AS BIGINT) AS Number FROM @Customer JOIN @LoyaltyMembership USING (CustomerID)")
def _(t, env):
    # text in, typed out
    text = t["Customer"].select("CustomerID", c("DateOfBirth").cast("string").alias("DateOfBirth")).join(
        t["LoyaltyMembership"].select("CustomerID", "LoyaltyNumber"), "CustomerID"
    )
    return text.select("CustomerID", F.to_date("DateOfBirth").alias("DateOfBirth"), F.substring("LoyaltyNumber", 3, 20).cast("long").alias("Number"))


@query("fn_ordinal_encode", "SELECT CustomerID, LoyaltyLevelEncoded FROM @Features")
def _(t, env):
    levels = t["LoyaltyMembership"].join(t["LoyaltyLevel"], "LoyaltyLevelID").select("CustomerID", "LevelName")
    rows = t["Customer"].select("CustomerID").join(levels, "CustomerID", "left")
    return rows.select("CustomerID", E.loyalty_ordinal(c("LevelName")).alias("LoyaltyLevelEncoded"))


@query("fn_fillna", f"SELECT c.CustomerID, coalesce(r.n, 0) AS n FROM @Customer c LEFT JOIN (SELECT CustomerID, count(*) AS n FROM @CampaignResponse GROUP BY 1) r ON r.CustomerID = c.CustomerID")
def _(t, env):
    facts = t["CampaignResponse"].groupBy("CustomerID").agg(F.count("*").alias("n"))
    return t["Customer"].select("CustomerID").join(facts, "CustomerID", "left").fillna(0, ["n"])


@query("fn_format", f"SELECT CampaignID, {percent_text('OpenRate')} AS OpenRate, {dollars_text('TotalRevenueGenerated')} AS Revenue FROM @Performance")
def _(t, env):
    return V.campaign_performance(t).select("CampaignID", E.percent_text(c("OpenRate")).alias("OpenRate"), E.dollars_text(c("TotalRevenueGenerated")).alias("Revenue"))


@query("fn_pad_lower_concat", "SELECT c_custkey AS CustomerID, 'LM' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS LoyaltyNumber, lower(split_part(c_name, '#', 1)) || '.' || c_custkey || '@example.com' AS Email FROM customer")
def _(t, env):
    number = F.concat(F.lit("LM"), F.lpad(c("CustomerID").cast("string"), 6, "0"))
    email = F.concat(F.lower("FirstName"), F.lit("."), c("CustomerID").cast("string"), F.lit("@example.com"))
    return t["Customer"].select("CustomerID", number.alias("LoyaltyNumber"), email.alias("Email"))


@query("fn_round_clamp", "SELECT TransactionItemID, ProductID, Quantity, CAST(greatest(CAST(LineTotal - 1000 AS DECIMAL(18,2)), 0) AS DOUBLE) AS Clamped FROM @SalesTransactionItem")
def _(t, env):
    rounded = F.round(c("LineTotal") - 1000, 2)
    return t["SalesTransactionItem"].select("TransactionItemID", "ProductID", "Quantity", F.greatest(rounded, F.lit(0).cast("decimal(18,2)")).alias("Clamped"))


@query("fn_trim", "SELECT AIReportID, length(nullif(trim(ReportText, ' '), '')) AS TextLength FROM @AIReport")
def _(t, env):
    return t["AIReport"].select("AIReportID", F.length(E.nonempty_text(c("ReportText"))).alias("TextLength"))
