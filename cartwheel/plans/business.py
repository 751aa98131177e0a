"""The business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators.ordering import argmax_row, top_k_ranked
from cartwheel.operators.select import null_or_before


def top_customers(tables, *, k: int = 20) -> DataFrame:
    """Best customers by revenue.  Facts are summed by key before the join, so
    a customer with many transactions is one row by then."""
    revenue = tables["SalesTransaction"].groupBy("CustomerID").agg(
        E.money_sum(F.col("TransactionTotal")).alias("TotalRevenue")
    )
    named = revenue.join(tables["Customer"].select("CustomerID", "FirstName", "LastName"), "CustomerID")
    best = top_k_ranked(named, k, "TotalRevenue", "CustomerID", "RevenueRank")
    return best.select("CustomerID", "FirstName", "LastName", "TotalRevenue", "RevenueRank")


def best_campaign(tables) -> DataFrame:
    """Highest response rate among campaigns that were sent."""
    rates = tables["CampaignResponse"].groupBy("CampaignID").agg(
        E.percent(F.count_if("PurchaseCompleted"), F.count("*")).alias("ResponseRatePct")
    )
    named = tables["MarketingCampaign"].select("CampaignID", "CampaignName").join(rates, "CampaignID")
    return argmax_row(named, "ResponseRatePct", "CampaignID")


def product_profit(tables, *, k: int = 20) -> DataFrame:
    """Best products by profit at the current price: units x (price - cost).
    Price and cost are constant per product, so units are summed first."""
    units = tables["SalesTransactionItem"].groupBy("ProductID").agg(F.sum("Quantity").alias("UnitsSold"))
    profit = (F.col("UnitsSold") * (F.col("UnitPrice") - F.col("UnitCost"))).cast("decimal(28,2)").cast("double")
    named = units.join(
        tables["Product"].select("ProductID", "ProductName", "UnitPrice", "UnitCost"), "ProductID"
    ).select("ProductID", "ProductName", "UnitsSold", profit.alias("TotalProfit"))
    return top_k_ranked(named, k, "TotalProfit", "ProductID", "ProfitRank")


def store_month(tables, *, k: int = 10) -> DataFrame:
    """Best single store-months by revenue."""
    monthly = tables["SalesTransaction"].groupBy(
        "StoreID", F.year("TransactionDate").alias("Yr"), F.month("TransactionDate").alias("Mo")
    ).agg(E.money_sum(F.col("TransactionTotal")).alias("MonthlyRevenue"))
    named = monthly.join(tables["Store"].select("StoreID", "StoreName"), "StoreID").select(
        "StoreID", "StoreName", "Yr", "Mo", "MonthlyRevenue"
    )
    # the unique grain decides ties
    best = named.withColumn("_grain", F.struct("StoreID", "Yr", "Mo"))
    return top_k_ranked(best, k, "MonthlyRevenue", "_grain", "RevenueRank").drop("_grain")


def loyalty_spend(tables) -> DataFrame:
    """Mean spend per member and level; members without purchases count as 0."""
    spend = tables["SalesTransaction"].groupBy("CustomerID").agg(
        F.sum(F.col("TransactionTotal").cast(E.MONEY)).alias("TotalSpend")
    )
    members = (
        tables["LoyaltyMembership"].select("CustomerID", "LoyaltyLevelID")
        .join(spend, "CustomerID", "left")
    )
    per_level = members.groupBy("LoyaltyLevelID").agg(
        F.sum("TotalSpend").cast("double").alias("_total"), F.count("*").alias("CustomerCount")
    )
    return (
        per_level.join(tables["LoyaltyLevel"], "LoyaltyLevelID")
        .select(
            "LevelName",
            E.ratio(E.zero_f(F.col("_total")), F.col("CustomerCount")).alias("AvgSpendPerCustomer"),
            "CustomerCount",
        )
        .orderBy(F.col("AvgSpendPerCustomer").desc(), F.col("LevelName").asc())
    )


def lapsed_customers(tables, *, as_of=None, months: int = 6) -> DataFrame:
    """Customers without a purchase in the last months, longest first; those
    who never bought come before all others."""
    last = tables["SalesTransaction"].groupBy("CustomerID").agg(F.max("TransactionDate").alias("LastTxnDate"))
    customers = tables["Customer"].select("CustomerID", "FirstName", "LastName").join(last, "CustomerID", "left")
    return (
        null_or_before(customers, "LastTxnDate", E.months_before(as_of, months))
        .withColumn("DaysSinceLastPurchase", E.days_since(F.col("LastTxnDate"), as_of))
        .orderBy(F.col("LastTxnDate").asc_nulls_first(), F.col("CustomerID").asc())
    )


def campaign_roi(tables) -> DataFrame:
    """Revenue from converters against the estimated discount cost."""
    revenue = tables["CampaignResponse"].where("PurchaseCompleted").groupBy("CampaignID").agg(
        E.money_sum(F.col("PurchaseAmount")).alias("Revenue")
    )
    cost = F.col("Revenue") * F.col("DiscountPercent").cast("double") / F.lit(100.0)
    return (
        tables["MarketingCampaign"].select("CampaignID", "CampaignName", "DiscountPercent")
        .join(revenue, "CampaignID")
        .withColumn("EstimatedDiscountCost", cost)
        .withColumn("ROI", E.ratio(F.col("Revenue") - F.col("EstimatedDiscountCost"), F.col("EstimatedDiscountCost")))
        .select("CampaignID", "CampaignName", "Revenue", "EstimatedDiscountCost", "ROI")
        .orderBy(F.col("ROI").desc_nulls_last(), F.col("CampaignID").asc())
    )
