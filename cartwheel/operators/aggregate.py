"""Aggregates that are not one built-in call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import expr as E


def rate_pct(flag: str) -> Column:
    """Percent of rows with the flag set; NULL over no rows."""
    return E.percent(F.count_if(F.col(flag)), F.count("*"))


def histogram(df: DataFrame, column: str, width: float, label: str = "BinStart") -> DataFrame:
    """Rows per bin of fixed width; a NULL bin holds the NULL values."""
    start = F.floor(F.col(column).cast("double") / F.lit(float(width))) * F.lit(float(width))
    return df.groupBy(start.alias(label)).agg(F.count("*").alias("RecordCount"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("RecordCount"))


def best_key_by_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Key with the highest mean; the first key wins a tie.  The sum is one of
    decimals, so that the order of the rows cannot turn a tie."""
    total = F.sum(F.col(value).cast("decimal(28,12)")).cast("double")
    return (
        df.groupBy(key)
        .agg(E.ratio(total, F.count(value)).alias("MeanValue"))
        .where("MeanValue is not null")
        .orderBy(F.col("MeanValue").desc(), F.col(key).asc())
        .limit(1)
    )
