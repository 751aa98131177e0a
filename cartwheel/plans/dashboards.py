"""Measures and dashboard datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators.aggregate import distribution, histogram, rate_pct
from cartwheel.operators.latest import latest_row
from cartwheel.operators.ordering import global_rank, top_k
from cartwheel.operators.select import only_key
from cartwheel.plans import views as V


# -- measures: one row, one column ---------------------------------------------

def total_revenue(tables) -> DataFrame:
    return tables["SalesTransaction"].agg(E.money_sum(F.col("TransactionTotal")).alias("TotalRevenue"))


def average_purchase_value(tables) -> DataFrame:
    total = E.money_sum(F.col("TransactionTotal"))
    return tables["SalesTransaction"].agg(E.ratio(total, F.count("TransactionTotal")).alias("AveragePurchaseValue"))


def response_rate(tables) -> DataFrame:
    """A fraction, unlike the percent columns of the views."""
    done = F.count_if("PurchaseCompleted")
    return tables["CampaignResponse"].agg(E.ratio(done, F.count("*")).alias("ResponseRate"))


def average_discount(tables) -> DataFrame:
    total = E.money_sum(F.col("Discount"), 4)
    return tables["SalesTransactionItem"].agg(E.ratio(total, F.count("Discount")).alias("AverageDiscount"))


def predicted_responders(tables) -> DataFrame:
    """Over all scoring runs, not only the newest."""
    return tables["CustomerPrediction"].agg(
        F.count_if(F.col("PredictionResult") == "Yes").alias("PredictedResponders")
    )


def prediction_accuracy(tables) -> DataFrame:
    newest = F.max_by(F.col("Accuracy").cast("double"), F.struct("ExecutionDate", "ExecutionID"))
    return tables["ModelExecution"].agg(newest.alias("PredictionAccuracy"))


def total_clv(tables) -> DataFrame:
    """Total lifetime value over all customers, from the transactions of known
    customers: the per-customer table is not needed for its sum."""
    known = tables["SalesTransaction"].groupBy("CustomerID").agg(
        F.sum(F.col("TransactionTotal").cast(E.MONEY)).alias("_spend")
    ).join(tables["Customer"].select("CustomerID"), "CustomerID", "left_semi")
    return known.agg(E.zero_f(F.sum("_spend").cast("double")).alias("TotalCLV"))


# -- dashboard 1: overview -----------------------------------------------------

def kpis(tables) -> DataFrame:
    """One row.  The single values are scalar subqueries of one aggregate."""
    customers = tables["Customer"].agg(
        F.count("*").alias("TotalCustomers"),
        F.count_if(F.col("CustomerStatus") == "Active").alias("ActiveCustomers"),
    )
    sales = tables["SalesTransaction"].agg(
        F.struct(
            E.money_sum(F.col("TransactionTotal")).alias("total"), F.count("TransactionTotal").alias("n")
        ).alias("s")
    ).scalar()
    return customers.select(
        "TotalCustomers", "ActiveCustomers",
        sales["total"].alias("TotalSales"),
        E.ratio(sales["total"], sales["n"]).alias("AveragePurchaseValue"),
        tables["MarketingCampaign"].agg(F.count("*")).scalar().alias("TotalCampaigns"),
        tables["CampaignResponse"].agg(rate_pct("PurchaseCompleted")).scalar().alias("CampaignResponseRate"),
        prediction_accuracy(tables).scalar().alias("PredictionAccuracy"),
        tables["AIReport"].agg(F.max("GeneratedDate")).scalar().alias("LastReportDate"),
    )


def monthly_sales(tables) -> DataFrame:
    month = F.date_format("TransactionDate", "yyyy-MM")
    return tables["SalesTransaction"].groupBy(month.alias("SalesMonth")).agg(
        E.money_sum(F.col("TransactionTotal")).alias("TotalSales")
    )


def customers_by_province(tables) -> DataFrame:
    return distribution(tables["Customer"], "Province")


def response_trend(tables) -> DataFrame:
    """Response rate per month."""
    month = F.date_format("ResponseDate", "yyyy-MM")
    return tables["CampaignResponse"].groupBy(month.alias("ResponseMonth")).agg(
        rate_pct("PurchaseCompleted").alias("ResponseRatePct")
    )


def latest_report_text(tables, *, report_type: str = "Executive Summary") -> DataFrame:
    reports = tables["AIReport"].where(F.col("ReportType") == report_type)
    return latest_row(reports, "GeneratedDate", "AIReportID").select("AIReportID", "GeneratedDate", "ReportText")


# -- dashboard 2: customers ----------------------------------------------------
# Only the facts a chart needs are aggregated, not the whole analytics table.

def age_histogram(tables, *, as_of=None, width: int = 10) -> DataFrame:
    ages = tables["Customer"].select(E.age_years(F.col("DateOfBirth"), as_of).alias("Age"))
    return histogram(ages, "Age", width)


def recency(tables, *, as_of=None) -> DataFrame:
    """Days since the last purchase of every customer, NULL for none."""
    last = tables["SalesTransaction"].groupBy("CustomerID").agg(F.max("TransactionDate").alias("_last"))
    return tables["Customer"].select("CustomerID").join(last, "CustomerID", "left").select(
        "CustomerID", E.days_since(F.col("_last"), as_of).alias("DaysSinceLastPurchase")
    )


def recency_histogram(tables, *, as_of=None, width: int = 30) -> DataFrame:
    return histogram(recency(tables, as_of=as_of), "DaysSinceLastPurchase", width)


def loyalty_distribution(tables) -> DataFrame:
    """Customers per level; the NULL level holds those without a membership."""
    per_level = (
        tables["Customer"].select("CustomerID")
        .join(tables["LoyaltyMembership"].select("CustomerID", "LoyaltyLevelID"), "CustomerID", "left")
        .groupBy("LoyaltyLevelID").agg(F.count("*").alias("RecordCount"))
    )
    return per_level.join(tables["LoyaltyLevel"], "LoyaltyLevelID", "left").select(
        F.col("LevelName").alias("LoyaltyLevel"), "RecordCount"
    )


def top_clv(tables, *, k: int = 10, as_of=None) -> DataFrame:
    return top_k(
        V.customer_ltv(tables, as_of=as_of), k, F.col("CustomerLifetimeValue").desc(), F.col("CustomerID").asc()
    )


def _customer_spend(tables) -> DataFrame:
    spent = tables["SalesTransaction"].groupBy("CustomerID").agg(
        F.count("*").alias("_n"), E.money_sum(F.col("TransactionTotal")).alias("_spend")
    )
    return tables["Customer"].select("CustomerID").join(spent, "CustomerID", "left")


def average_purchase_by_level(tables) -> DataFrame:
    """Mean of the customers' average purchase, per level and overall (the row
    with ``IsOverall``)."""
    average = E.zero_f(E.ratio(F.col("_spend"), F.col("_n")))
    members = _customer_spend(tables).select("CustomerID", average.alias("_avg")).join(
        tables["LoyaltyMembership"].select("CustomerID", "LoyaltyLevelID"), "CustomerID", "left"
    ).join(tables["LoyaltyLevel"], "LoyaltyLevelID", "left")
    return members.withColumnRenamed("LevelName", "LoyaltyLevel").rollup("LoyaltyLevel").agg(
        (F.grouping("LoyaltyLevel") == 1).alias("IsOverall"),
        F.avg("_avg").alias("AvgPurchaseValue"),
    )


def purchase_frequency(tables) -> DataFrame:
    """Customers by number of transactions."""
    per_customer = _customer_spend(tables).select(E.zero(F.col("_n")).alias("NumTransactions"))
    return distribution(per_customer, "NumTransactions")


# -- dashboard 3: sales ----------------------------------------------------------

def _line_revenue():
    return E.money_sum(F.col("LineTotal"), 4).alias("Revenue")


def revenue_by_store(tables) -> DataFrame:
    """Line revenue per store.  Lines are summed per transaction, which is also
    the join key, before stores are attached."""
    per_transaction = tables["SalesTransactionItem"].groupBy("TransactionID").agg(
        F.sum("LineTotal").alias("LineTotal")
    )
    per_store = (
        tables["SalesTransaction"].select("TransactionID", "StoreID").join(per_transaction, "TransactionID")
        .groupBy("StoreID").agg(_line_revenue())
    )
    return per_store.join(tables["Store"].select("StoreID", "StoreName", "Province"), "StoreID").select(
        "StoreID", "StoreName", "Province", "Revenue"
    )


def _revenue_per_product(tables) -> DataFrame:
    return tables["SalesTransactionItem"].groupBy("ProductID").agg(F.sum("LineTotal").alias("LineTotal"))


def revenue_by_category(tables) -> DataFrame:
    per_category = (
        _revenue_per_product(tables).join(tables["Product"].select("ProductID", "CategoryID"), "ProductID")
        .groupBy("CategoryID").agg(_line_revenue())
    )
    return per_category.join(tables["ProductCategory"], "CategoryID").select("CategoryID", "CategoryName", "Revenue")


def monthly_line_sales(tables) -> DataFrame:
    per_transaction = tables["SalesTransactionItem"].groupBy("TransactionID").agg(
        F.sum("LineTotal").alias("LineTotal")
    )
    return (
        tables["SalesTransaction"].select("TransactionID", "TransactionDate").join(per_transaction, "TransactionID")
        .groupBy(F.year("TransactionDate").alias("SalesYear"), F.month("TransactionDate").alias("SalesMonth"))
        .agg(_line_revenue())
    )


def revenue_by_product(tables, *, k: int = 10) -> DataFrame:
    revenue = _revenue_per_product(tables).select("ProductID", F.col("LineTotal").cast("double").alias("Revenue"))
    named = revenue.join(tables["Product"].select("ProductID", "ProductName"), "ProductID")
    return top_k(named, k, F.col("Revenue").desc(), F.col("ProductID").asc())


# -- dashboard 4: campaigns --------------------------------------------------------

def campaign_funnel(tables) -> DataFrame:
    """Contacted, opened, coupon used and purchased per campaign."""
    return (
        tables["MarketingCampaign"].select("CampaignID", "CampaignName")
        .join(V.campaign_counts(tables["CampaignResponse"]), "CampaignID", "left")
        .select(
            "CampaignID", "CampaignName",
            E.zero(F.col("_contacted")).alias("Contacted"),
            E.zero(F.col("_opened")).alias("Opened"),
            E.zero(F.col("_coupons")).alias("CouponUsed"),
            E.zero(F.col("_completed")).alias("Purchased"),
        )
    )


def campaign_ranking(tables) -> DataFrame:
    """Every campaign with its rank by revenue."""
    ranked = global_rank(V.campaign_performance(tables), "TotalRevenueGenerated", "RevenueRank")
    return ranked.select("RevenueRank", "CampaignID", "CampaignName", "ChannelName", "TotalRevenueGenerated",
                         "PurchaseCompletionRate")


def campaign_drillthrough(tables, *, campaign_id=None) -> DataFrame:
    """Customer-level responses of one campaign, or of all."""
    return (
        only_key(tables["CampaignResponse"], "CampaignID", campaign_id)
        .join(tables["Customer"].select("CustomerID", "FirstName", "LastName", "Province"), "CustomerID")
        .select("CampaignID", "ResponseID", "CustomerID", "FirstName", "LastName", "Province", "EmailOpened",
                "CouponUsed", "PurchaseCompleted", "PurchaseAmount", "ResponseDate")
    )


# -- dashboard 5: model ------------------------------------------------------------

def confusion_matrix(tables) -> DataFrame:
    """Newest outcome x newest prediction, where both are known."""
    known = V.prediction_results(tables).where("PredictionCorrect is not null")
    return known.groupBy(
        F.col("ActualPurchaseCompleted").alias("Actual"), F.col("PredictionResult").alias("Predicted")
    ).agg(F.count("*").alias("RecordCount"))


def model_metrics(tables) -> DataFrame:
    newest = latest_row(tables["ModelExecution"], "ExecutionDate", "ExecutionID")
    return newest.select("ExecutionID", "Accuracy", F.col("Precision_").alias("Precision"), "Recall", "F1Score")


def probability_histogram(tables, *, bins: int = 10) -> DataFrame:
    """Predictions per equal-width bin of [0, 1]; 1 belongs to the last bin."""
    bin_no = F.least(F.floor(F.col("PredictionProbability") * bins), F.lit(bins - 1)).cast("int")
    return tables["CustomerPrediction"].groupBy(bin_no.alias("Bin")).agg(F.count("*").alias("RecordCount"))


# -- dashboard 6: reports ------------------------------------------------------------

def report_index(tables) -> DataFrame:
    return tables["AIReport"].select(
        "AIReportID", "ReportType", "CampaignID", "GeneratedDate", "PromptVersion", "Approved"
    ).orderBy(F.col("GeneratedDate").desc(), F.col("AIReportID").desc())
