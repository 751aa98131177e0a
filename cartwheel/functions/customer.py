"""The five per-customer functions, each as one set-based DataFrame:
one row per customer with ``CustomerID`` and the value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators.select import only_key


def _per_customer(tables, customer_id, facts: str, aggregates, value) -> DataFrame:
    """One aggregate of ``facts`` per customer, kept for customers without any."""
    base = only_key(tables["Customer"].select("CustomerID"), "CustomerID", customer_id)
    # the key is also applied to the facts, so that one customer reads little
    grouped = only_key(tables[facts], "CustomerID", customer_id).groupBy("CustomerID").agg(*aggregates)
    return base.join(grouped, "CustomerID", "left").select("CustomerID", value)


def customer_age(tables, *, as_of=None, customer_id=None) -> DataFrame:
    rows = only_key(tables["Customer"], "CustomerID", customer_id)
    return rows.select("CustomerID", E.age_years(F.col("DateOfBirth"), as_of).alias("Age"))


def customer_lifetime_value(tables, *, customer_id=None) -> DataFrame:
    total = F.sum(F.col("TransactionTotal").cast(E.MONEY)).alias("total")
    value = F.coalesce(F.col("total"), F.lit(0)).cast("decimal(18,2)").alias("CustomerLifetimeValue")
    return _per_customer(tables, customer_id, "SalesTransaction", [total], value)


def average_purchase(tables, *, customer_id=None) -> DataFrame:
    # sum and count instead of avg: the average is rounded once, to cents
    aggregates = [
        F.sum(F.col("TransactionTotal").cast(E.MONEY)).alias("total"),
        F.count("TransactionTotal").alias("n"),
    ]
    mean = F.col("total") / F.nullif(F.col("n"), F.lit(0))
    value = F.coalesce(mean.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("AveragePurchase")
    return _per_customer(tables, customer_id, "SalesTransaction", aggregates, value)


def campaign_response_rate(tables, *, customer_id=None) -> DataFrame:
    aggregates = [F.count("*").alias("n"), F.count_if("PurchaseCompleted").alias("done")]
    rate = F.col("done").cast("decimal(18,4)") * 100 / F.nullif(F.col("n"), F.lit(0))
    value = F.coalesce(rate.cast("decimal(5,2)"), F.lit(0).cast("decimal(5,2)")).alias("CampaignResponseRate")
    return _per_customer(tables, customer_id, "CampaignResponse", aggregates, value)


def days_since_last_purchase(tables, *, as_of=None, customer_id=None) -> DataFrame:
    last = F.max("TransactionDate").alias("last")
    value = E.days_since(F.col("last"), as_of).alias("DaysSinceLastPurchase")
    return _per_customer(tables, customer_id, "SalesTransaction", [last], value)
