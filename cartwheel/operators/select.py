"""Filters and slicers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only_key(df: DataFrame, column: str, key=None) -> DataFrame:
    """Rows of one key, or all rows when no key is given.  Decided before
    planning, so that a given key is pushed down to the scan."""
    return df if key is None else df.where(F.col(column) == key)


def equal_to(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def in_list(df: DataFrame, column: str, values) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows outside [low, high]; NULL is no violation."""
    return df.where(~F.col(column).between(low, high))


def null_or_before(df: DataFrame, column: str, cutoff: Column) -> DataFrame:
    return df.where(F.col(column).isNull() | (F.col(column) < cutoff))


def slice_rows(df: DataFrame, *, province=None, start=None, end=None, campaign=None, date_column=None) -> DataFrame:
    """The report slicers: province, half-open date range, campaign.  Each one
    applies only when given."""
    if province is not None:
        df = df.where(F.col("Province") == province)
    if (start is not None or end is not None) and date_column is None:
        raise ValueError("a date range needs date_column")
    if start is not None:
        df = df.where(F.col(date_column) >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(date_column) < F.lit(str(end)).cast("timestamp_ntz"))
    if campaign is not None:
        df = df.where(F.col("CampaignID") == campaign)
    return df
