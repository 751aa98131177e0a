"""The canonical tables as projections of TPC-H-like Parquet tables.

Every binding is a projection, with at most a join to the 25-row nation table,
so filters and column pruning reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.sources import schemas
from cartwheel.sources.files import lookup_table

SALES_AS_OF = "2001-08-02 00:00:00"
ANALYTICS_AS_OF = "2024-02-01 00:00:00"

# Fixed values of this binding: market segment -> loyalty level.
SEGMENT_LEVELS = {
    "BUILDING": (1, "Bronze"), "AUTOMOBILE": (2, "Silver"), "FURNITURE": (3, "Gold"),
    "MACHINERY": (4, "Platinum"), "HOUSEHOLD": (5, "Household"),
}
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CHANNELS, TYPES = (schemas.SEEDS[name][2] for name in ("MarketingChannel", "CampaignType"))
ROLES = ["Till Lead", "Floor Staff", "Buyer", "Driver", "Analyst"]
REPORT_TYPES = [
    "Executive Summary", "Campaign Analysis", "Prediction Interpretation", "Business Recommendations",
    "Dashboard Commentary",
]


# Columns of the Parquet tables, declared so that no job has to infer them.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Tables(dict):
    """Canonical tables by name, each built when first asked for."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, name):
        self[name] = self._builders[name]()
        return self[name]

    def __contains__(self, name):
        return name in self._builders

    def get(self, name, default=None):
        return self[name] if name in self else default


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{folder}/{name}.parquet")


def _pick(index: str, names) -> str:
    """names[index] for a zero-based index."""
    return f"element_at(array({', '.join(repr(n) for n in names)}), CAST({index} AS INT) + 1)"


def _scaled(units: str, scale: int, precision: int = 18) -> str:
    """Decimal from a whole number of its smallest units."""
    return f"CAST(CAST({units} AS DECIMAL(18,0)) * {10 ** -scale:.{scale}f}BD AS DECIMAL({precision},{scale}))"


# The doubles hold at most two decimals: whole cents and percents are exact
# integers, which become decimals much faster than doubles do.
_GROSS = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
_OFF = f"({_GROSS} * CAST(rint(l_discount * 100) AS BIGINT))"
_BIRTH = "date_add(DATE'1940-01-01', CAST(c_custkey * 7919 % 22000 AS INT))"
_EARNED = "(c_custkey * 37 % 20000)"
_REDEEMED = f"CAST(floor({_EARNED} * (c_custkey % 10) / 10D) AS BIGINT)"
_POINTS = "((c_custkey * 37 + run * 11) % 101)"
_LEVEL = "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN {i}" for s, (i, _) in SEGMENT_LEVELS.items()) + " ELSE 0 END"


def _metric(step: int) -> str:
    return _scaled(f"(6000 + s_suppkey * {step} % 3000)", 4, 5)


# Canonical table -> (source, filter, columns).  Customers in debt have no
# membership and the richest have no score, so that left joins have gaps.
PROJECTIONS = {
    "Store": ("places", None, [
        "CAST(n_nationkey AS BIGINT) AS StoreID", "concat('Store ', n_name) AS StoreName", "n_name AS City",
        "r_name AS Province",
    ]),
    "Customer": ("customer_home", None, [
        "c_custkey AS CustomerID", "substring_index(c_name, '#', 1) AS FirstName",
        "substring_index(c_name, '#', -1) AS LastName",
        _pick("c_custkey % 3", ["Male", "Female", "Non-binary"]) + " AS Gender",
        f"{_BIRTH} AS DateOfBirth",
        f"CAST(floor(datediff(DATE'2012-01-01', {_BIRTH}) / 365D) AS INT) AS Age",
        "format_string('user%d@example.com', c_custkey % 1400) AS Email",
        "format_string('555-%04d', c_custkey % 10000) AS Phone",
        "format_string('%d Main St', c_custkey % 9990 + 10) AS Address",
        "n_name AS City", "r_name AS Province",
        "format_string('K%dA%s%dB%d', c_custkey % 10, IF(c_custkey % 2 = 0, ' ', ''), c_custkey % 7, c_custkey % 9)"
        " AS PostalCode",
        "date_add(DATE'1990-01-01', CAST(c_custkey % 1500 AS INT)) AS RegistrationDate",
        "CASE WHEN c_custkey % 20 = 0 THEN 'Suspended' WHEN c_custkey % 20 <= 2 THEN 'Inactive' ELSE 'Active' END"
        " AS CustomerStatus",
    ]),
    "LoyaltyMembership": ("customer", None, [
        "c_custkey AS CustomerID", "format_string('LM%06d', c_custkey) AS LoyaltyNumber",
        f"CAST({_LEVEL} AS BIGINT) AS LoyaltyLevelID",
        "date_add(DATE'1990-01-01', CAST(c_custkey % 1500 + c_custkey % 100 AS INT)) AS JoinDate",
        f"{_EARNED} - {_REDEEMED} AS CurrentPoints", f"{_EARNED} AS LifetimePointsEarned",
        f"{_REDEEMED} AS LifetimePointsRedeemed",
    ]),
    "Employee": ("supplier", None, [
        "s_suppkey AS EmployeeID", "substring_index(s_name, '#', 1) AS FirstName",
        "substring_index(s_name, '#', -1) AS LastName", _pick("s_suppkey % 5", ROLES) + " AS Role",
        "CAST(s_nationkey AS BIGINT) AS StoreID",
    ]),
    "Product": ("part", None, [
        "p_partkey AS ProductID", "p_name AS ProductName",
        f"array_position(array({', '.join(repr(t) for t in PART_TYPES)}), p_type) AS CategoryID", "p_brand AS Brand",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS UnitPrice",
        "CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.6BD AS DECIMAL(10,2)) AS UnitCost",
    ]),
    "MarketingCampaign": ("part", None, [
        "p_partkey AS CampaignID", "concat('Promotion of ', p_name, ' ', p_partkey) AS CampaignName",
        "p_partkey % 5 + 1 AS MarketingChannelID",
        "CAST(CASE WHEN p_partkey % 40 >= 30 THEN 1 WHEN p_partkey % 40 >= 15 THEN 2 WHEN p_partkey % 40 > 0 THEN 3"
        " ELSE 4 END AS BIGINT) AS CampaignTypeID",
        "date_add(DATE'2024-01-01', CAST(p_partkey % 10 AS INT)) AS StartDate",
        "date_add(DATE'2024-01-15', CAST(p_partkey % 10 AS INT)) AS EndDate",
        "CAST(p_partkey % 40 AS DECIMAL(5,2)) AS DiscountPercent",
    ]),
    "SalesTransaction": ("orders", None, [
        "o_orderkey AS TransactionID", "o_custkey AS CustomerID", "o_orderkey % 25 AS StoreID",
        "o_orderdate AS TransactionDate", "CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS PaymentMethodID",
        _scaled("CAST(rint(o_totalprice * 100) AS BIGINT)", 2, 10) + " AS TransactionTotal",
    ]),
    "SalesTransactionItem": ("lineitem", None, [
        "l_orderkey * 10 + l_linenumber AS TransactionItemID", "l_orderkey AS TransactionID", "l_partkey AS ProductID",
        "CAST(l_quantity AS INT) AS Quantity",
        # whole cents per unit, rounded down
        _scaled("floor(l_extendedprice * 100 / l_quantity)", 2, 14) + " AS UnitPrice",
        _scaled(_OFF, 4) + " AS Discount", _scaled(f"({_GROSS} * 100 - {_OFF})", 4) + " AS LineTotal",
    ]),
    "CampaignResponse": ("events", None, [
        "event_id AS ResponseID", "CAST(get_json_object(props, '$.k') AS BIGINT) AS CampaignID",
        "user_id AS CustomerID", "event_type IN ('view', 'click', 'purchase') AS EmailOpened",
        "event_type IN ('click', 'purchase') AS CouponUsed", "event_type = 'purchase' AS PurchaseCompleted",
        "IF(event_type = 'purchase', CAST(value AS DECIMAL(10,2)), CAST(0 AS DECIMAL(10,2))) AS PurchaseAmount",
        "ts AS ResponseDate",
    ]),
    # runs 1 and 2 of the score
    "CustomerPrediction": ("scored", None, [
        "c_custkey * 2 + run AS PredictionID", "c_custkey AS CustomerID",
        "IF(run = 1, TIMESTAMP_NTZ'2024-01-20 06:00:00', TIMESTAMP_NTZ'2024-01-27 06:00:00') AS PredictionDate",
        _scaled(f"{_POINTS} * 100", 4, 5) + " AS PredictionProbability",
        f"IF({_POINTS} >= 50, 'Yes', 'No') AS PredictionResult", "'RandomForest' AS MLModel", "'v1.0' AS ModelVersion",
    ]),
    "ModelExecution": ("supplier", None, [
        "s_suppkey AS ExecutionID",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(CAST(s_suppkey % 28 AS INT)) AS ExecutionDate",
        "'RandomForest' AS Algorithm", f"{_metric(37)} AS Accuracy", f"{_metric(53)} AS Precision_",
        f"{_metric(71)} AS Recall", f"{_metric(97)} AS F1Score",
        "CAST(s_suppkey % 600 AS DECIMAL(10,2)) AS ExecutionDurationSeconds",
    ]),
    "AIReport": ("documents", None, [
        "doc_id AS AIReportID", _pick("doc_id % 5", REPORT_TYPES) + " AS ReportType",
        "IF(doc_id % 5 = 1, doc_id % 100, NULL) AS CampaignID",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id % 40000 AS INT)) AS GeneratedDate",
        "'report-model' AS ModelName", "IF(doc_id % 2 = 0, 'v1.0', 'v1.1') AS PromptVersion", "text AS ReportText",
        "doc_id % 3 = 0 AS Approved",
    ]),
}

# Canonical lookup table -> (names, id column, name column).
LOOKUPS = {
    "ProductCategory": (PART_TYPES, "CategoryID", "CategoryName"),
    "LoyaltyLevel": ([n for _, n in SEGMENT_LEVELS.values()], "LoyaltyLevelID", "LevelName"),
    "PaymentMethod": (PRIORITIES, "PaymentMethodID", "MethodName"),
    "MarketingChannel": (CHANNELS, "MarketingChannelID", "ChannelName"),
    "CampaignType": (TYPES, "CampaignTypeID", "TypeName"),
}


def bind(spark: SparkSession, folder: str) -> Tables:
    def raw(name):
        return raw_table(spark, folder, name)

    def places():
        return raw("nation").join(raw("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")

    def customer_home():
        # grouped by its key: the optimizer sees at most one match per customer
        # and drops the join from queries that use no place
        home = places().selectExpr("n_nationkey AS c_nationkey", "struct(n_name, r_name) AS home").groupBy("c_nationkey")
        return raw("customer").join(home.agg({"home": "first"}), "c_nationkey", "left").selectExpr("*", "`first(home)`.*")

    def scored():
        return raw("customer").selectExpr("c_custkey", "explode(array(1, 2)) AS run")

    derived = {"places": places, "customer_home": customer_home, "scored": scored}

    def project(source, condition, columns):
        rows = derived[source]() if source in derived else raw(source)
        return (rows.where(condition) if condition else rows).selectExpr(*columns)

    builders = {name: (lambda spec=spec: project(*spec)) for name, spec in PROJECTIONS.items()}
    for name, (names, id_column, name_column) in LOOKUPS.items():
        builders[name] = lambda n=names, i=id_column, c=name_column: lookup_table(spark, n, i, c)
    return Tables(builders)
