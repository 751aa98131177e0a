"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import quality as Q
from cartwheel.plans import views as V
from cartwheel.sources import schemas as S
from cartwheel.sources.bindings import ANALYTICS_AS_OF
from registry.canon import age, count_if
from registry.core import query


def _union(parts):
    return " UNION ALL ".join(parts)


@query("dq_table_existence", _union(f"SELECT '{n}' AS TableName, true AS Present, count(*) > 0 AS HasRows FROM @{n}" for n in S.TABLES))
def _(t, env):
    return Q.table_existence(t, S.TABLES)


# Rows of a full dataset.
_EXPECTED = {
    "Store": 25, "ProductCategory": 18, "Product": 500, "Customer": 5_000, "LoyaltyMembership": 5_000, "Employee": 250, "MarketingCampaign": 40,
    "SalesTransaction": 75_000, "SalesTransactionItem": 250_000, "CampaignResponse": 18_000,
}


@query("dq_row_counts", _union(
    f"SELECT '{n}' AS TableName, count(*) AS RecordCount, CAST({v} AS BIGINT) AS Expected, count(*) = {v} AS Matches FROM @{n}"
    for n, v in _EXPECTED.items()))
def _(t, env):
    return Q.compare_counts(Q.row_counts(t, list(_EXPECTED)), _EXPECTED)


def _orphans(keys):
    return _union(
        f"""SELECT '{child}.{key}' AS Relation, count(*) AS OrphanCount FROM @{child} c
        WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM @{parent} p WHERE p.{parent_key} = c.{key})"""
        for child, key, parent, parent_key in keys
    )


@query("dq_orphans", _orphans(S.LOAD_CHECK_KEYS))
def _(t, env):
    return Q.orphans(t, S.LOAD_CHECK_KEYS)


@query("dq_fk_constraints", _orphans(S.FOREIGN_KEYS))
def _(t, env):
    return Q.orphans(t, S.FOREIGN_KEYS)


_DUPLICATES = [("Customer", "CustomerID"), ("SalesTransaction", "TransactionID"), ("SalesTransactionItem", "TransactionItemID"),
               ("Customer", "Email"), ("LoyaltyMembership", "LoyaltyNumber")]


@query("dq_duplicate_keys", _union(
    f"SELECT '{table}.{key}' AS KeyName, CAST({key} AS VARCHAR) AS KeyValue, count(*) AS Occurrences FROM @{table} GROUP BY {key} HAVING count(*) > 1"
    for table, key in _DUPLICATES))
def _(t, env):
    return Q.stack_rows([
        Q.duplicate_keys(t[table], key).select(
            F.lit(f"{table}.{key}").alias("KeyName"), F.col(key).cast("string").alias("KeyValue"), "Occurrences"
        ) for table, key in _DUPLICATES
    ])


_CHECKS = {
    ("Customer", "age_18_to_120"): "Age < 18 OR Age > 120",
    ("Customer", "status_known"): "CustomerStatus NOT IN ('Active', 'Inactive', 'Suspended')",
    ("Product", "price_not_negative"): "UnitPrice < 0",
    ("Product", "cost_not_negative"): "UnitCost < 0",
    ("MarketingCampaign", "percent_0_to_100"): "DiscountPercent < 0 OR DiscountPercent > 100",
    ("MarketingCampaign", "end_after_start"): "EndDate < StartDate",
    ("SalesTransaction", "total_not_negative"): "TransactionTotal < 0",
    ("SalesTransactionItem", "quantity_positive"): "Quantity <= 0",
    ("SalesTransactionItem", "price_not_negative"): "UnitPrice < 0",
    ("SalesTransactionItem", "discount_not_negative"): "Discount < 0",
    ("SalesTransactionItem", "line_total_not_negative"): "LineTotal < 0",
    ("CampaignResponse", "amount_not_negative"): "PurchaseAmount < 0",
    ("LoyaltyMembership", "points_not_negative"): "CurrentPoints < 0 OR LifetimePointsEarned < 0 OR LifetimePointsRedeemed < 0",
    ("CustomerPrediction", "probability_0_to_1"): "PredictionProbability < 0 OR PredictionProbability > 1",
    ("CustomerPrediction", "result_known"): "PredictionResult NOT IN ('Yes', 'No')",
    ("ModelExecution", "metrics_0_to_1"): "greatest(Accuracy, Precision_, Recall, F1Score) > 1 OR least(Accuracy, Precision_, Recall, F1Score) < 0",
}


def _violations(wanted):
    return _union(
        f"SELECT '{table}' AS TableName, '{rule}' AS RuleName, {count_if(bad)} AS Violations FROM @{table}"
        for (table, rule), bad in _CHECKS.items() if (table, rule) in wanted
    )


@query("dq_range_rules", _violations([("CampaignResponse", "amount_not_negative"), ("MarketingCampaign", "percent_0_to_100"),
                                      ("Customer", "age_18_to_120"), ("SalesTransaction", "total_not_negative")]))
def _(t, env):
    return Q.broken_rules(t, S.range_rules())


@query("dq_check_constraints", _violations(_CHECKS))
def _(t, env):
    return Q.broken_rules(t, S.check_rules())


@query("dq_one_membership", "SELECT CustomerID FROM @Customer c WHERE NOT EXISTS (SELECT 1 FROM @LoyaltyMembership m WHERE m.CustomerID = c.CustomerID)")
def _(t, env):
    return Q.unmatched(t["Customer"], t["LoyaltyMembership"], "CustomerID")


# Unique columns, plus the two that grow with the tables.
_UNIQUE = S.UNIQUE_COLUMNS + [("Customer", "Email"), ("Product", "ProductName")]


@query("dq_unique_constraints", _union(
    f"SELECT '{table}.{column}' AS Constraint_, count(*) AS DuplicateValues FROM (SELECT {column} FROM @{table} GROUP BY 1 HAVING count(*) > 1) x"
    for table, column in _UNIQUE))
def _(t, env):
    return Q.stack_rows([
        Q.duplicate_keys(t[table], column).agg(F.count("*").alias("DuplicateValues")).select(
            F.lit(f"{table}.{column}").alias("Constraint_"), "DuplicateValues"
        ) for table, column in _UNIQUE
    ])


@query("dq_not_null", _union(
    f"SELECT '{table}' AS TableName, '{c}' AS RuleName, {count_if(f'{c} IS NULL')} AS Violations FROM @{table}"
    for table, columns in S.NOT_NULL.items() for c in columns))
def _(t, env):
    return Q.null_counts(t, S.NOT_NULL)


_COLUMNS = ["CustomerID", "Age", "Province", "LoyaltyLevel", "NumTransactions", "TotalAmountSpent", "AveragePurchaseValue", "DaysSinceLastPurchase",
            "NumCampaignsReceived", "CampaignResponseRate", "NumDistinctProductsPurchased", "AverageDiscountReceived", "PurchaseCompleted"]


@query("dq_profile_customer_analytics", "SELECT * FROM (" + _union(
    ["SELECT 'rows' AS Section, 'row_count' AS Item, count(*) AS Value FROM @Analytics",
     "SELECT 'duplicates', 'CustomerID', count(*) - count(DISTINCT CustomerID) FROM @Analytics",
     "SELECT 'invalid', 'Age_out_of_range', count(CASE WHEN Age < 18 OR Age > 120 THEN 1 END) FROM @Analytics",
     "SELECT 'invalid', 'TotalAmountSpent_negative', count(CASE WHEN TotalAmountSpent < 0 THEN 1 END) FROM @Analytics"]
    + [f"SELECT 'missing', '{c}', count(*) - count({c}) FROM @Analytics" for c in _COLUMNS]) + ") x WHERE Value > 0 OR Section IN ('rows', 'duplicates')")
def _(t, env):
    return Q.profile_customer_analytics(V.customer_analytics(t, as_of=ANALYTICS_AS_OF))


@query("dq_shared_values", """SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS SharedRows,
    CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS DOUBLE) * 100.0 / CAST(sum(n) AS DOUBLE) AS SharedPct
    FROM (SELECT Email, count(*) AS n FROM @Customer GROUP BY 1) x""")
def _(t, env):
    return Q.shared_values(t["Customer"], "Email")


_CONSTANT = {"CustomerPrediction": ["PredictionDate", "PredictionResult", "MLModel", "ModelVersion"], "SalesTransaction": ["TransactionTotal"]}


@query("dq_constant_column", _union(
    f"SELECT '{c}' AS ColumnName, coalesce(count(DISTINCT {c}) = 1, false) AS IsConstant, count({c}) AS NonNullRows FROM @{n}"
    for n, columns in _CONSTANT.items() for c in columns))
def _(t, env):
    first, second = (Q.constant_columns(t[n], columns) for n, columns in _CONSTANT.items())
    return first.unionByName(second)


@query("dq_stale_age", f"""SELECT CustomerID, Age, {age('DateOfBirth')} AS CurrentAge, Age < 18 AS StoredUnder18 FROM @Customer
    WHERE Age <> {age('DateOfBirth')}""")
def _(t, env):
    return Q.stale_age(t["Customer"], ANALYTICS_AS_OF)


@query("dq_line_arithmetic", """SELECT TransactionItemID, CAST(LineTotal AS DOUBLE) AS LineTotal FROM @SalesTransactionItem
    WHERE abs(LineTotal - (Quantity * UnitPrice - Discount)) > 0.005""")
def _(t, env):
    return Q.line_arithmetic(t["SalesTransactionItem"]).select("TransactionItemID", "LineTotal")


@query("dq_format_mix", "SELECT length(PostalCode) AS CodeLength, contains(PostalCode, ' ') AS HasSpace, count(*) AS RecordCount FROM @Customer GROUP BY 1, 2")
def _(t, env):
    return Q.text_format_mix(t["Customer"], "PostalCode")


_DOMAINS = [("Customer", "CustomerStatus"), ("CampaignResponse", "EmailOpened"), ("CampaignResponse", "CouponUsed"),
            ("CampaignResponse", "PurchaseCompleted"), ("CustomerPrediction", "PredictionResult")]


@query("dq_domain_values", _union(
    f"SELECT '{table}.{c}' AS ColumnName, CAST({c} AS VARCHAR) AS Value, count(*) AS RecordCount FROM @{table} GROUP BY {c}" for table, c in _DOMAINS))
def _(t, env):
    return Q.stack_rows([
        Q.value_counts(t[table], c).select(F.lit(f"{table}.{c}").alias("ColumnName"), "Value", "RecordCount")
        for table, c in _DOMAINS
    ])
