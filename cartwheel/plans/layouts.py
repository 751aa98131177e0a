"""Stored layouts for questions that come again and again.

Three catalogued copies of loaded tables, each in a database of the caller's:
facts bucketed by transaction (star queries join them where they lie), the
tables of a customer bucketed by customer (one customer reads one bucket of
each), and a cube of sales cells with mergeable sketches (a new roll-up reads
cells, not transactions).
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.select import only_key
from cartwheel.operators.sinks import save_bucketed
from cartwheel.plans import views as V

FACTS = ["SalesTransaction", "SalesTransactionItem"]
OF_CUSTOMER = ["Customer", "LoyaltyMembership", "SalesTransaction", "CampaignResponse"]
LINES = "CustomerLine"
CUBE = "SalesCube"
CUBE_DIMENSIONS = ["SalesYear", "SalesMonth", "StoreID", "CategoryID"]
# 2 ** 14 registers: 0.8 % standard error, at most about 16 kB a cell; cells of
# up to some hundred transactions are exact.
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


# -- facts by transaction -----------------------------------------------------------

def store_facts(tables: Mapping[str, DataFrame], database: str, buckets: int) -> None:
    """Transactions and lines, bucketed alike and sorted by transaction."""
    create_database(tables[FACTS[0]].sparkSession, database)
    for name in FACTS:
        save_bucketed(tables[name], f"{database}.{name}", "TransactionID", buckets)


def with_stored_facts(tables: Mapping[str, DataFrame], database: str) -> Mapping[str, DataFrame]:
    """The tables with the bucketed facts in place of the others, for any view."""
    spark = tables[FACTS[0]].sparkSession
    return ChainMap({name: spark.table(f"{database}.{name}") for name in FACTS}, tables)


# -- one customer ---------------------------------------------------------------------

def store_by_customer(tables: Mapping[str, DataFrame], database: str, buckets: int) -> None:
    """The tables with a customer, and the lines with that of their transaction,
    bucketed by customer.  The join of lines and transactions is paid once.
    ``buckets`` should make a bucket a few hundred MB; a customer on a very
    large share of the rows makes its bucket larger, whose files are still
    read in splits."""
    spark = tables["Customer"].sparkSession
    create_database(spark, database)
    for name in OF_CUSTOMER:
        save_bucketed(tables[name], f"{database}.{name}", "CustomerID", buckets)
    lines = tables["SalesTransactionItem"].select("TransactionID", "ProductID", "Discount").join(
        tables["SalesTransaction"].select("TransactionID", "CustomerID"), "TransactionID")
    save_bucketed(lines, f"{database}.{LINES}", "CustomerID", buckets)
    tables["LoyaltyLevel"].write.mode("overwrite").saveAsTable(f"{database}.LoyaltyLevel")


def customer_metrics(spark: SparkSession, database: str, customer_id: int, *, as_of=None) -> DataFrame:
    """The metrics of one customer, from one bucket of each table."""
    tables = {name: spark.table(f"{database}.{name}") for name in [*OF_CUSTOMER, "LoyaltyLevel"]}
    tables["SalesTransactionItem"] = only_key(spark.table(f"{database}.{LINES}"), "CustomerID", customer_id)
    return V.customer_metrics(tables, customer_id=customer_id, as_of=as_of)


# -- cube -----------------------------------------------------------------------------

def sales_cube(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per year, month, store and category: exact revenue and units, and
    a sketch of the transactions, which span categories and so cannot be
    added up."""
    return V.categorised_lines(tables).groupBy(*CUBE_DIMENSIONS).agg(
        F.sum(F.col("LineTotal").cast("decimal(18,4)")).alias("Revenue"),
        F.sum("Quantity").alias("UnitsSold"),
        F.hll_sketch_agg("TransactionID", SKETCH_BITS).alias("Transactions"),
    )


def store_cube(tables: Mapping[str, DataFrame], database: str) -> None:
    create_database(tables["Store"].sparkSession, database)
    sales_cube(tables).write.mode("overwrite").saveAsTable(f"{database}.{CUBE}")


def cube_rollup(cube: DataFrame, dimensions: Sequence[str] = ("SalesYear", "StoreID", "CategoryID")) -> DataFrame:
    """Subtotals over any of the cube's dimensions, last one first, from its
    cells.  Revenue and units are exact; ``TransactionCount`` is an estimate
    with a standard error of ``SKETCH_ERROR``, merged from the cells' sketches.
    The exact count is ``views.sales_rollup``."""
    unknown = set(dimensions) - set(CUBE_DIMENSIONS)
    if unknown:
        raise ValueError(f"not in the cube: {', '.join(sorted(unknown))}")
    return cube.rollup(*dimensions).agg(
        F.grouping_id().alias("GroupingLevel"),
        F.sum("Revenue").cast("double").alias("Revenue"),
        F.sum("UnitsSold").alias("UnitsSold"),
        F.hll_sketch_estimate(F.hll_union_agg("Transactions")).alias("TransactionCount"),
    )
