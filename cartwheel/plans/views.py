"""The named datasets: five views and the parameterised result sets on them."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators.latest import latest_flag, latest_per_key
from cartwheel.operators.select import only_key


def transaction_facts(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("CustomerID").agg(
        F.count("*").alias("NumTransactions"),
        E.money_sum(F.col("TransactionTotal")).alias("TotalAmountSpent"),
        F.max("TransactionDate").alias("LastPurchaseDate"),
    )


def product_facts(transactions: DataFrame, items: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Distinct products and mean line discount per customer.

    The single distinct count is planned as partial aggregates by (customer,
    product) first, so one customer's lines spread over all tasks.  With
    ``approx_distinct`` a sketch counts instead and that shuffle goes away.
    """
    products = F.approx_count_distinct if approx_distinct else F.count_distinct
    lines = transactions.select("TransactionID", "CustomerID").join(
        items.select("TransactionID", "ProductID", "Discount"), "TransactionID"
    )
    per_customer = lines.groupBy("CustomerID").agg(
        products("ProductID").alias("NumDistinctProducts"),
        E.money_sum(F.col("Discount"), 4).alias("_discount"),
        F.count("Discount").alias("_lines"),
    )
    return per_customer.select(
        "CustomerID", "NumDistinctProducts", E.ratio(F.col("_discount"), F.col("_lines")).alias("AvgDiscountReceived")
    )


def response_facts(responses: DataFrame, exclude_latest: bool = False) -> DataFrame:
    """Campaign counts and the newest outcome, in one pass over the responses.

    ``exclude_latest`` leaves the newest response out of the counts, so that
    the rate no longer contains the label it is meant to predict.
    """
    facts = responses.groupBy("CustomerID").agg(
        F.count("*").alias("NumCampaignsReceived"),
        F.count_if("PurchaseCompleted").alias("_completed"),
        latest_flag("PurchaseCompleted", "ResponseDate", "ResponseID").alias("PurchaseCompleted"),
    )
    if exclude_latest:
        facts = facts.withColumns({
            "NumCampaignsReceived": F.col("NumCampaignsReceived") - 1,
            "_completed": F.col("_completed") - F.when(F.col("PurchaseCompleted"), 1).otherwise(0),
        })
    return facts


def customer_analytics(tables, *, as_of=None, exclude_latest: bool = False, customer_id=None,
                       approx_distinct: bool = False) -> DataFrame:
    """One row per customer: the model input.

    Each fact table is aggregated by customer before the join; the joins then
    work on one row per customer and share the customer partitioning.
    """
    def of_customer(name):
        return only_key(tables[name], "CustomerID", customer_id)

    transactions = of_customer("SalesTransaction")
    # all lines meet their transactions by hash, not by two sorts; one customer's few may be broadcast
    bought = transactions.hint("shuffle_hash") if customer_id is None else transactions
    levels = tables["LoyaltyMembership"].select("CustomerID", "LoyaltyLevelID").join(
        tables["LoyaltyLevel"].select("LoyaltyLevelID", F.col("LevelName").alias("LoyaltyLevel")),
        "LoyaltyLevelID", "left",
    )
    joined = (
        of_customer("Customer").select("CustomerID", "DateOfBirth", "Province")
        .join(only_key(levels, "CustomerID", customer_id), "CustomerID", "left")
        .join(transaction_facts(transactions), "CustomerID", "left")
        .join(product_facts(bought, tables["SalesTransactionItem"], approx_distinct), "CustomerID", "left")
        .join(response_facts(of_customer("CampaignResponse"), exclude_latest), "CustomerID", "left")
    )
    return joined.select(
        "CustomerID",
        E.age_years(F.col("DateOfBirth"), as_of).alias("Age"),
        "Province",
        "LoyaltyLevel",
        E.zero(F.col("NumTransactions")).alias("NumTransactions"),
        E.zero_f(F.col("TotalAmountSpent")).alias("TotalAmountSpent"),
        E.zero_f(E.ratio(F.col("TotalAmountSpent"), F.col("NumTransactions"))).alias("AveragePurchaseValue"),
        E.days_since(F.col("LastPurchaseDate"), as_of).alias("DaysSinceLastPurchase"),
        E.zero(F.col("NumCampaignsReceived")).alias("NumCampaignsReceived"),
        E.zero_f(E.percent(F.col("_completed"), F.col("NumCampaignsReceived"))).alias("CampaignResponseRate"),
        E.zero(F.col("NumDistinctProducts")).alias("NumDistinctProductsPurchased"),
        E.zero_f(F.col("AvgDiscountReceived")).alias("AverageDiscountReceived"),
        "PurchaseCompleted",
    )


def campaign_counts(responses: DataFrame) -> DataFrame:
    """One row per contacted campaign, combined map-side: a campaign holding
    most of the responses costs no more than any other."""
    nonzero = F.nullif(F.col("PurchaseAmount"), F.lit(0).cast("decimal(10,2)"))
    return responses.groupBy("CampaignID").agg(
        F.count("ResponseID").alias("_contacted"),
        F.count_if("EmailOpened").alias("_opened"),
        F.count_if("CouponUsed").alias("_coupons"),
        F.count_if("PurchaseCompleted").alias("_completed"),
        E.money_sum(F.col("PurchaseAmount")).alias("_revenue"),
        F.count(nonzero).alias("_paying"),
    )


def campaign_performance(tables, *, campaign_id=None) -> DataFrame:
    """One row per campaign, never-sent ones included: their counts, revenue
    and average are 0, their rates NULL."""
    campaigns = only_key(tables["MarketingCampaign"], "CampaignID", campaign_id)
    responses = only_key(tables["CampaignResponse"], "CampaignID", campaign_id)
    contacted, n = F.col("_contacted"), E.zero(F.col("_contacted"))
    return (
        campaigns.join(tables["MarketingChannel"], "MarketingChannelID")
        .join(campaign_counts(responses), "CampaignID", "left")
        .select(
            "CampaignID", "CampaignName", "ChannelName", "DiscountPercent",
            n.alias("CustomersContacted"),
            E.percent(F.col("_opened"), contacted).alias("OpenRate"),
            E.percent(F.col("_completed"), contacted).alias("PurchaseCompletionRate"),
            E.zero_f(F.col("_revenue")).alias("TotalRevenueGenerated"),
            E.zero_f(E.ratio(F.col("_revenue"), F.col("_paying"))).alias("AveragePurchaseAmount"),
        )
    )


def categorised_lines(tables) -> DataFrame:
    """Sold lines with store, month and category ids, one row per line.

    Products come first and transactions last, so that the lines end up
    partitioned by transaction.  No side is forced into a broadcast: a small
    product table becomes one by its measured size, hot products of a large
    one are split by AQE.
    """
    sold = (
        tables["SalesTransactionItem"].select("TransactionID", "ProductID", "Quantity", "LineTotal")
        .join(tables["Product"].select("ProductID", "CategoryID"), "ProductID")
        .join(tables["SalesTransaction"].select("TransactionID", "StoreID", "TransactionDate"), "TransactionID")
    )
    return sold.withColumns({"SalesYear": F.year("TransactionDate"), "SalesMonth": F.month("TransactionDate")})


def sales_lines(tables) -> DataFrame:
    """The whole star around the sold lines."""
    return (
        categorised_lines(tables)
        .join(tables["Store"].select("StoreID", "StoreName", "Province"), "StoreID")
        .join(tables["ProductCategory"], "CategoryID")
    )


TRANSACTION_DIMENSIONS = ["SalesYear", "SalesMonth", "StoreID"]


def sales_cells(tables, dimensions) -> DataFrame:
    """One row per combination of the dimensions (of a transaction, and
    CategoryID): revenue, units, ``_in`` (transactions with a line there) and
    ``_first`` (transactions counted in one of their cells only).

    A transaction has one date and one store, so only categories repeat it.
    Lines are marked, not grouped, by transaction and category where the join
    has put them: they are sorted once, and no task holds a map of its
    transactions.  What is shuffled after that is summed map-side, and nothing
    is shuffled by transaction twice.
    """
    own = [d for d in TRANSACTION_DIMENSIONS if d in dimensions]
    if set(dimensions) - {*own, "CategoryID"}:
        raise ValueError("dimensions are a transaction's or CategoryID")
    lines = categorised_lines(tables).select("TransactionID", *own, "CategoryID", F.col("LineTotal").cast("decimal(18,4)").alias("LineTotal"), "Quantity")
    # the first line of each category, and whether that is the transaction's first one
    order = Window.partitionBy("TransactionID").orderBy(F.col("CategoryID").asc_nulls_last(), *own)
    cell = F.struct("CategoryID", *own)
    marked = lines.withColumns({"_new": ~cell.eqNullSafe(F.lag(cell).over(order)), "_least": F.first("CategoryID").over(order)})
    return marked.groupBy(*dimensions).agg(
        F.sum("LineTotal").alias("Revenue"),
        F.sum("Quantity").alias("UnitsSold"),
        F.count_if("_new").alias("_in"),
        F.count_if(F.col("_new") & F.col("CategoryID").eqNullSafe(F.col("_least"))).alias("_first"),
    )


def sales_performance(tables) -> DataFrame:
    """Year x month x store x category.  Lines are grouped by ids; the names
    join the small result, not the lines."""
    cells = sales_cells(tables, ["SalesYear", "SalesMonth", "StoreID", "CategoryID"])
    return (
        cells.join(tables["Store"].select("StoreID", "StoreName", "Province"), "StoreID")
        .join(tables["ProductCategory"], "CategoryID")
        .select("SalesYear", "SalesMonth", "StoreID", "StoreName", "Province", "CategoryID", "CategoryName",
                F.col("Revenue").cast("double").alias("Revenue"), "UnitsSold", F.col("_in").alias("TransactionCount"))
    )


def sales_rollup(tables, dimensions=("SalesYear", "StoreID", "CategoryID")) -> DataFrame:
    """Subtotals over the dimensions, last one first.  A transaction that
    spans categories counts once in every subtotal: in its cell where the level
    tells categories apart, else in its first cell only.  What is rolled up
    are the cells, not lines or transactions."""
    dims = list(dimensions)
    # one row per key on that side: a small hash table a partition instead of two sorts
    hashed = ChainMap({"SalesTransaction": tables["SalesTransaction"].hint("shuffle_hash")}, tables)
    cells = sales_cells(hashed, dims)
    for table, key in (("Store", "StoreID"), ("ProductCategory", "CategoryID")):
        if key in dims:  # sales of an unknown store or category are left out, as in the other views
            cells = cells.join(tables[table].select(key), key, "left_semi")
    count = F.sum("_in")
    if "CategoryID" in dims:
        count = F.when(F.grouping("CategoryID") == 1, F.sum("_first")).otherwise(F.sum("_in"))
    return cells.rollup(*dims).agg(
        F.grouping_id().alias("GroupingLevel"),
        F.sum("Revenue").cast("double").alias("Revenue"),
        F.sum("UnitsSold").alias("UnitsSold"),
        count.alias("TransactionCount"),
    )


def customer_ltv(tables, *, as_of=None) -> DataFrame:
    """Spend to date per customer; lifetime value is that spend by definition."""
    spent = tables["SalesTransaction"].groupBy("CustomerID").agg(
        F.count("*").alias("_n"), E.money_sum(F.col("TransactionTotal")).alias("_spend")
    )
    spend = E.zero_f(F.col("_spend"))
    return (
        tables["Customer"].select("CustomerID", "FirstName", "LastName", "RegistrationDate")
        .join(spent, "CustomerID", "left")
        .select(
            "CustomerID", "FirstName", "LastName",
            spend.alias("TotalHistoricalSpend"),
            E.zero(F.col("_n")).alias("NumTransactions"),
            E.days_since(F.col("RegistrationDate"), as_of).alias("TenureDays"),
            spend.alias("CustomerLifetimeValue"),
        )
    )


def prediction_results(tables) -> DataFrame:
    """Newest prediction against newest outcome, per customer."""
    predicted = latest_per_key(tables["CustomerPrediction"], "CustomerID", "PredictionDate", "PredictionID").select(
        "CustomerID", "PredictionDate", "PredictionProbability", "PredictionResult", "MLModel", "ModelVersion"
    )
    outcome = latest_per_key(
        tables["CampaignResponse"].select("CustomerID", "ResponseDate", "ResponseID", "PurchaseCompleted"),
        "CustomerID", "ResponseDate", "ResponseID",
    ).select("CustomerID", F.col("PurchaseCompleted").alias("ActualPurchaseCompleted"))
    return (
        tables["Customer"].select("CustomerID", "FirstName", "LastName")
        .join(predicted, "CustomerID", "left")
        .join(outcome, "CustomerID", "left")
        .withColumn(
            "PredictionCorrect",
            E.prediction_correct(F.col("PredictionResult"), F.col("ActualPurchaseCompleted")),
        )
    )


# -- parameterised result sets ------------------------------------------------

def customer_metrics(tables, *, customer_id=None, as_of=None) -> DataFrame:
    return customer_analytics(tables, as_of=as_of, customer_id=customer_id)


def prediction_dataset(tables, *, as_of=None) -> DataFrame:
    return customer_analytics(tables, as_of=as_of)


def campaign_summary(tables, *, campaign_id=None) -> DataFrame:
    return campaign_performance(tables, campaign_id=campaign_id).orderBy(
        F.col("TotalRevenueGenerated").desc(), F.col("CampaignID").asc()
    )


def model_history(tables) -> DataFrame:
    return tables["ModelExecution"].orderBy(F.col("ExecutionDate").desc(), F.col("ExecutionID").desc())


VIEWS = {
    "CustomerAnalytics": customer_analytics,
    "CampaignPerformance": campaign_performance,
    "SalesPerformance": sales_performance,
    "CustomerLifetimeValue": customer_ltv,
    "PredictionResults": prediction_results,
}


def bi_model(tables, table_names, *, as_of=None) -> dict[str, DataFrame]:
    """The import model of the dashboards: named tables and the five views."""
    model = {name: tables[name] for name in table_names}
    for name, view in VIEWS.items():
        timed = name in ("CustomerAnalytics", "CustomerLifetimeValue")
        model[f"vw{name}"] = view(tables, as_of=as_of) if timed else view(tables)
    return model
