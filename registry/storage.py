"""Sources, sinks and table maintenance.  Queries that write do so in a new
folder of the shared scratch space and return what is stored."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators import dimensions as Dim
from cartwheel.operators import quality as Q
from cartwheel.operators import sinks
from cartwheel.plans import layouts
from cartwheel.plans import learning as L
from cartwheel.plans import load
from cartwheel.plans import reports as R
from cartwheel.plans import views as V
from cartwheel.session import materialize
from cartwheel.sources import files, schemas as S
from cartwheel.sources.bindings import ANALYTICS_AS_OF, raw_table
from registry.canon import AS_OF, CANON, count_if, money, ratio
from registry.core import optional_numbers, query, scratch

# -- sources ----------------------------------------------------------------------


def _export(df, name, env):
    """One source file under its name in a new folder."""
    folder = scratch(env, "csv")
    sinks.export_csv(df, f"{folder}/{name}.csv")
    return folder


@query("scan_csv", "SELECT ProductID, ProductName, CategoryID, Brand, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(UnitCost AS DOUBLE) AS UnitCost FROM @Product")
def _(t, env):
    columns = ["ProductID", "ProductName", "CategoryID", "Brand", "UnitPrice", "UnitCost"]
    return files.scan_source(env.spark, _export(t["Product"].select(*columns), "Products", env), "Products")


_MEMBERS = """SELECT m.LoyaltyNumber, m.CustomerID, l.LevelName AS MembershipLevel, CAST(m.JoinDate AS VARCHAR) AS JoinDate, m.CurrentPoints,
    m.LifetimePointsEarned, m.LifetimePointsRedeemed FROM @LoyaltyMembership m JOIN @LoyaltyLevel l ON l.LoyaltyLevelID = m.LoyaltyLevelID"""


@query("scan_csv_staged", _MEMBERS)
def _(t, env):
    staged = t["LoyaltyMembership"].join(t["LoyaltyLevel"], "LoyaltyLevelID").select(
        "LoyaltyNumber", "CustomerID", F.col("LevelName").alias("MembershipLevel"), "JoinDate", "CurrentPoints",
        "LifetimePointsEarned", "LifetimePointsRedeemed",
    )
    return files.scan_source(env.spark, _export(staged, "LoyaltyMemberships", env), "LoyaltyMemberships")


@query("scan_csv_project", """SELECT City, CustomerID, nullif(Gender, 'Non-binary') AS Gender, CAST(DateOfBirth AS VARCHAR) AS DateOfBirth FROM @Customer""")
def _(t, env):
    names = [c.split()[0] for c in S.CSV_FILES["Customers"].split(", ")]
    # some text that means missing, to be read as NULL
    gender = F.when(F.col("Gender") == "Non-binary", "NA").otherwise(F.col("Gender"))
    folder = _export(t["Customer"].withColumn("Gender", gender).select(*names), "Customers", env)
    return files.scan_csv_project(env.spark, folder, "Customers", ["City", "CustomerID", "Gender", "DateOfBirth"])


@query("scan_table", "SELECT TransactionID, CustomerID, TransactionDate, CAST(TransactionTotal AS DOUBLE) AS TransactionTotal FROM @SalesTransaction")
def _(t, env):
    folder = scratch(env, "tables")
    sinks.write_table(t["SalesTransaction"], folder, "SalesTransaction")
    return files.scan_table(env.spark, folder, "SalesTransaction",
                            ["TransactionID", "CustomerID", "TransactionDate", "TransactionTotal"])


_MODEL = [(n, n) for n in S.BI_TABLES] + [("vwCustomerAnalytics", "Analytics"), ("vwCampaignPerformance", "Performance"),
          ("vwSalesPerformance", "Sales"), ("vwCustomerLifetimeValue", "Ltv"), ("vwPredictionResults", "Results")]


@query("scan_bi_model", " UNION ALL ".join(f"SELECT '{name}' AS Dataset, count(*) AS RecordCount FROM @{ref}" for name, ref in _MODEL))
def _(t, env):
    model = V.bi_model(t, S.BI_TABLES, as_of=ANALYTICS_AS_OF)
    names = files.register_views(model, "bi_")
    return env.spark.sql(" UNION ALL ".join(f"SELECT '{n[3:]}' AS Dataset, count(*) AS RecordCount FROM {n}" for n in names))


# -- load --------------------------------------------------------------------------

_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS TableName, count(*) AS RecordCount FROM @{n}" for n in S.LOADED_TABLES)


# Exact sums over the loaded tables; a stored name stands for its id, which a load may number anew.
_MEASURES = {
    "Store": ("Store", ["sum(StoreID)", "sum(length(StoreName))", "count(DISTINCT Province)"]),
    "ProductCategory": ("ProductCategory", ["sum(CategoryID * length(CategoryName))"]),
    "Product": ("Product", ["sum(ProductID * CategoryID)", "CAST(sum(UnitPrice) AS DOUBLE)", "CAST(sum(UnitCost) AS DOUBLE)"]),
    "Customer": ("Customer", ["sum(CustomerID * Age)", "sum(length(Email))", "count(DISTINCT DateOfBirth)", "sum(month(RegistrationDate))"]),
    "LoyaltyMembership": ("LoyaltyMembership JOIN {0}LoyaltyLevel USING (LoyaltyLevelID)",
                          ["sum(CustomerID * length(LevelName))", "sum(CurrentPoints)", "sum(LifetimePointsEarned - LifetimePointsRedeemed)"]),
    "Employee": ("Employee", ["sum(EmployeeID * StoreID)", "sum(length(Role))"]),
    "MarketingCampaign": ("MarketingCampaign JOIN {0}MarketingChannel USING (MarketingChannelID)",
                          ["sum(CampaignID * length(ChannelName))", "sum(CampaignID * CampaignTypeID)", "CAST(sum(DiscountPercent) AS DOUBLE)"]),
    "SalesTransaction": ("SalesTransaction JOIN {0}PaymentMethod USING (PaymentMethodID)",
                         ["sum(TransactionID * length(MethodName))", "sum(CustomerID)", "CAST(sum(TransactionTotal) AS DOUBLE)", "sum(day(TransactionDate))"]),
    "SalesTransactionItem": ("SalesTransactionItem", ["sum(TransactionID)", "sum(ProductID * Quantity)", "CAST(sum(LineTotal) AS DOUBLE)"]),
    "CampaignResponse": ("CampaignResponse", ["sum(CampaignID)", "sum(CustomerID)", "count(CASE WHEN EmailOpened THEN 1 END)",
                                              "count(CASE WHEN CouponUsed THEN 1 END)", "CAST(sum(PurchaseAmount) AS DOUBLE)"]),
}


def _measures(prefix: str, tables: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS TableName, CAST({i} AS BIGINT) AS Measure, CAST({measure} AS DOUBLE) AS Value FROM {prefix}{source.format(prefix)}"
        for name, (source, measures) in tables.items() for i, measure in enumerate(["count(*)", *measures]))


# What the source files hold: line amounts to the cent, ages and totals to be recomputed.
_LOADED = f"""SELECT * FROM (WITH r_SalesTransactionItem AS (
        SELECT * REPLACE (CAST(LineTotal AS DECIMAL(10,2)) AS LineTotal) FROM @SalesTransactionItem),
    r_SalesTransaction AS (SELECT s.* REPLACE (CAST(coalesce(l.total, 0) AS DECIMAL(10,2)) AS TransactionTotal) FROM @SalesTransaction s
        LEFT JOIN (SELECT TransactionID, sum(LineTotal) AS total FROM r_SalesTransactionItem GROUP BY 1) l USING (TransactionID)),
    r_Customer AS (SELECT * REPLACE (CAST(floor(date_diff('day', DateOfBirth, CAST({AS_OF} AS DATE)) / 365.0) AS BIGINT) AS Age) FROM @Customer),
    {", ".join(f"r_{n} AS (SELECT * FROM @{n})" for n in ("Store", "ProductCategory", "Product", "LoyaltyMembership", "LoyaltyLevel", "Employee", "MarketingCampaign", "MarketingChannel", "PaymentMethod", "CampaignResponse"))}
    {_measures("r_", _MEASURES)}) x"""


def _loaded_twice(t, env, **options):
    """A store that has been loaded and refreshed; its second version counts."""
    source, target = scratch(env, "source"), scratch(env, "load")
    load.export_sources(t, source)
    for _ in range(2):
        counts = load.load_full_refresh(env.spark, source, target, as_of=ANALYTICS_AS_OF, **options)
    return target, counts


@query("load_full_refresh", _LOADED)
def _(t, env):
    target, _counts = _loaded_twice(t, env)
    files.register_views(files.scan_store(env.spark, target), "loaded_")
    return env.spark.sql(_measures("loaded_", _MEASURES))


@query("load_written_counts", _COUNTS)
def _(t, env):
    # as counted by the writes, with the reader that sets bad lines aside
    return _loaded_twice(t, env, max_rejects=10)[1]


def _staged_transactions(t):
    return t["SalesTransaction"].join(t["PaymentMethod"], "PaymentMethodID").select(
        "TransactionID", F.col("MethodName").alias("PaymentMethod")
    )


_METHODS = """SELECT CAST(i AS BIGINT) AS PaymentMethodID, n AS MethodName FROM (VALUES (1, 'Cash'), (2, 'Credit'), (3, 'Debit'), (4, 'Mobile Payment')) v(i, n)
    UNION ALL SELECT 4 + row_number() OVER (ORDER BY md5(o_orderpriority)), o_orderpriority FROM (SELECT DISTINCT o_orderpriority FROM orders) x"""


def _stored_lookup(t, env):
    """The lookup table as a load stores it: its size is then known, so that
    resolving keys does not shuffle the facts by a handful of names."""
    return materialize(_upserted(t, env), "lookup")


def _upserted(t, env):
    seeds = files.seed_table(env.spark, "PaymentMethod")
    return Dim.upsert_missing(_staged_transactions(t), "PaymentMethod", seeds, "MethodName", "PaymentMethodID")


@query("dim_upsert_missing", _METHODS)
def _(t, env):
    return _upserted(t, env)


@query("dim_resolve_fk", f"SELECT o.o_orderkey AS TransactionID, d.PaymentMethodID FROM orders o JOIN ({_METHODS}) d ON d.MethodName = o.o_orderpriority")
def _(t, env):
    return Dim.resolve_key(_staged_transactions(t), "PaymentMethod", _stored_lookup(t, env), "MethodName", "PaymentMethodID")


@query("join_lookup_dict", f"SELECT o.o_orderkey AS TransactionID, d.PaymentMethodID FROM orders o JOIN ({_METHODS}) d ON lower(d.MethodName) = lower(o.o_orderpriority)")
def _(t, env):
    # names in another case match too when asked for
    staged = _staged_transactions(t).withColumn("PaymentMethod", F.lower("PaymentMethod"))
    return Dim.resolve_key(staged, "PaymentMethod", _stored_lookup(t, env), "MethodName", "PaymentMethodID", case_insensitive=True)


_TYPED = "SELECT CampaignID, CampaignTypeID, CAST(DiscountPercent AS DOUBLE) AS DiscountPercent FROM @MarketingCampaign"


@query("derive_campaign_type", _TYPED)
def _(t, env):
    untyped = t["MarketingCampaign"].select("CampaignID", "DiscountPercent")
    return Dim.resolve_campaign_type(untyped, files.seed_table(env.spark, "CampaignType"))


@query("join_lateral_top1", """SELECT CampaignID, CampaignTypeID FROM @MarketingCampaign""")
def _(t, env):
    untyped = t["MarketingCampaign"].select("CampaignID", "DiscountPercent")
    return Dim.resolve_campaign_type(untyped, t["CampaignType"]).select("CampaignID", "CampaignTypeID")


@query("recompute_transaction_total", """SELECT s.TransactionID, s.CustomerID, s.StoreID, s.TransactionDate, s.PaymentMethodID,
    CAST(CAST(coalesce(l.total, 0) AS DECIMAL(10,2)) AS DOUBLE) AS TransactionTotal
    FROM @SalesTransaction s LEFT JOIN (SELECT TransactionID, sum(LineTotal) AS total FROM @SalesTransactionItem GROUP BY 1) l
    ON l.TransactionID = s.TransactionID""")
def _(t, env):
    return load.recompute_totals(t["SalesTransaction"], t["SalesTransactionItem"])


@query("recompute_age_load", f"SELECT CustomerID, CAST(floor(date_diff('day', DateOfBirth, CAST({AS_OF} AS DATE)) / 365.0) AS BIGINT) AS Age FROM @Customer")
def _(t, env):
    return load.recompute_age(t["Customer"], ANALYTICS_AS_OF).select("CustomerID", "Age")


# -- appends -------------------------------------------------------------------------

_SCORE = "CAST((CustomerID * 13 % 1000) / 1000.0 AS DECIMAL(5,4))"


def _scores(t):
    probability = (F.col("CustomerID") * 13 % 1000) / 1000.0
    return t["Customer"].select(
        "CustomerID", probability.alias("Probability"), E.yes_no(probability).alias("Result")
    )


@query("append_prediction", f"""SELECT PredictionID, CustomerID, PredictionDate, CAST(PredictionProbability AS DOUBLE) AS PredictionProbability,
    PredictionResult, MLModel, ModelVersion FROM @CustomerPrediction UNION ALL
    SELECT (SELECT max(PredictionID) FROM @CustomerPrediction) + row_number() OVER (ORDER BY md5(CAST(CustomerID AS VARCHAR))), CustomerID, {AS_OF},
    CAST({_SCORE} AS DOUBLE), CASE WHEN {_SCORE} >= 0.5 THEN 'Yes' ELSE 'No' END, 'RandomForest', 'v1.0' FROM @Customer""")
def _(t, env):
    folder = scratch(env, "predictions")
    sinks.write_table(t["CustomerPrediction"], folder, "CustomerPrediction")
    stored = files.scan_table(env.spark, folder, "CustomerPrediction")
    rows = sinks.prediction_rows(_scores(t), stored, ml_model=L.ALGORITHM, model_version=L.MODEL_VERSION, as_of=ANALYTICS_AS_OF)
    sinks.write_table(rows, folder, "CustomerPrediction", "append")
    return files.scan_table(env.spark, folder, "CustomerPrediction")


_CELLS = """(SELECT count(CASE WHEN PredictionResult = 'Yes' AND ActualPurchaseCompleted THEN 1 END) AS tp,
    count(CASE WHEN PredictionResult = 'Yes' AND NOT ActualPurchaseCompleted THEN 1 END) AS fp,
    count(CASE WHEN PredictionResult = 'No' AND ActualPurchaseCompleted THEN 1 END) AS fn,
    count(CASE WHEN PredictionResult = 'No' AND NOT ActualPurchaseCompleted THEN 1 END) AS tn FROM @Results) c"""
_ACCURACY, _PRECISION, _RECALL, _F1 = (
    f"coalesce({ratio(a, b)}, 0.0)"
    for a, b in [("tp + tn", "tp + tn + fp + fn"), ("tp", "tp + fp"), ("tp", "tp + fn"), ("tp * 2", "tp * 2 + fp + fn")]
)


def judged(t):
    """Newest outcome and newest prediction as label and prediction."""
    known = V.prediction_results(t).where("PredictionCorrect is not null")
    return known.select(
        "CustomerID", F.col("ActualPurchaseCompleted").cast("int").alias("label"),
        (F.col("PredictionResult") == "Yes").cast("int").alias("prediction"),
    )


_EXEC = """ExecutionID, Algorithm, CAST(Accuracy AS DOUBLE) AS Accuracy, CAST(Precision_ AS DOUBLE) AS Precision_,
    CAST(Recall AS DOUBLE) AS Recall, CAST(F1Score AS DOUBLE) AS F1Score"""


@query("append_model_execution", f"""SELECT {_EXEC} FROM @ModelExecution UNION ALL
    SELECT (SELECT max(ExecutionID) FROM @ModelExecution) + 1, 'RandomForest', CAST(CAST({_ACCURACY} AS DECIMAL(5,4)) AS DOUBLE),
    CAST(CAST({_PRECISION} AS DECIMAL(5,4)) AS DOUBLE), CAST(CAST({_RECALL} AS DECIMAL(5,4)) AS DOUBLE), CAST(CAST({_F1} AS DECIMAL(5,4)) AS DOUBLE) FROM {_CELLS}""")
def _(t, env):
    folder = scratch(env, "executions")
    sinks.write_table(t["ModelExecution"], folder, "ModelExecution")
    stored = files.scan_table(env.spark, folder, "ModelExecution")
    row = sinks.execution_row(L.evaluate_classifier(judged(t)), stored, algorithm=L.ALGORITHM, duration_seconds=12.5,
                              as_of=ANALYTICS_AS_OF)
    sinks.write_table(row, folder, "ModelExecution", "append")
    return files.scan_table(env.spark, folder, "ModelExecution", ["ExecutionID", "Algorithm", "Accuracy", "Precision_", "Recall", "F1Score"])


@query("append_report", f"""SELECT AIReportID, ReportType, CAST(CampaignID AS DOUBLE) AS CampaignID, GeneratedDate, Approved FROM @AIReport UNION ALL
    SELECT (SELECT max(AIReportID) FROM @AIReport) + row_number() OVER (ORDER BY md5('Campaign Analysis|' || CampaignID)), 'Campaign Analysis', CampaignID,
    {AS_OF}, false FROM @MarketingCampaign""")
def _(t, env):
    folder = scratch(env, "reports")
    sinks.write_table(t["AIReport"], folder, "AIReport")
    stored = files.scan_table(env.spark, folder, "AIReport")
    written = R.campaign_prompts(V.campaign_performance(t)).select(
        F.lit("Campaign Analysis").alias("ReportType"), "CampaignID", F.col("Prompt").alias("ReportText")
    )
    rows = sinks.report_rows(written, stored, model_name="report-model", prompt_version=R.PROMPT_VERSION, as_of=ANALYTICS_AS_OF)
    sinks.write_table(rows, folder, "AIReport", "append")
    columns = ["AIReportID", "ReportType", "CampaignID", "GeneratedDate", "Approved"]
    return optional_numbers(files.scan_table(env.spark, folder, "AIReport", columns), "CampaignID")


@query("approve_report", """SELECT AIReportID, ReportText, CASE AIReportID WHEN 7 THEN true WHEN 9 THEN false ELSE Approved END AS Approved FROM @AIReport""")
def _(t, env):
    folder = scratch(env, "reports")
    sinks.write_table(t["AIReport"], folder, "AIReport")
    for report, approve in ((7, True), (9, True), (9, False)):
        sinks.approve_report(env.spark, folder, report, approve, as_of=ANALYTICS_AS_OF)
    return files.scan_table(env.spark, folder, "AIReport", ["AIReportID", "ReportText", "Approved"])


@query("default_values", """SELECT ResponseID, EmailOpened, CouponUsed, PurchaseCompleted,
    CAST(PurchaseAmount AS DOUBLE) AS PurchaseAmount FROM @CampaignResponse""")
def _(t, env):
    # values left out on purpose; the defaults put them back
    partial = t["CampaignResponse"].select(
        "ResponseID", "CouponUsed", "PurchaseCompleted",
        F.when(F.col("EmailOpened"), True).alias("EmailOpened"),
        F.when(F.col("PurchaseCompleted"), F.col("PurchaseAmount")).alias("PurchaseAmount"),
    )
    return sinks.with_defaults(partial, "CampaignResponse")


_KEYS = {"Customer": "CustomerID", "LoyaltyMembership": "CustomerID", "SalesTransactionItem": "TransactionItemID", "CampaignResponse": "ResponseID",
         "CustomerPrediction": "PredictionID", "AIReport": "AIReportID", "ModelExecution": "ExecutionID"}


def _default_sql(value):
    return AS_OF if value == "now" else f"'{value}'" if isinstance(value, str) else str(value).lower()


@query("default_values_all", " UNION ALL ".join(
    f"SELECT '{table}' AS TableName, '{column}' AS ColumnName, count(CASE WHEN {_KEYS[table]} % 2 = 0 OR {column} = {_default_sql(value)} THEN 1 END) AS DefaultRows,"
    f" count(*) AS RecordCount FROM @{table}" for table, columns in S.DEFAULTS.items() for column, value in columns.items()))
def _(t, env):
    # every column that has a default, left out in every second row
    found = []
    for table, columns in S.DEFAULTS.items():
        partial = t[table].withColumns({column: F.when(F.col(_KEYS[table]) % 2 != 0, F.col(column)) for column in columns})
        filled = sinks.with_defaults(partial, table, ANALYTICS_AS_OF)
        for column, value in columns.items():
            default = E.now(ANALYTICS_AS_OF) if value == "now" else F.lit(value)
            found.append(filled.agg(F.count_if(F.col(column) == default).alias("DefaultRows"), F.count("*").alias("RecordCount")).select(
                F.lit(table).alias("TableName"), F.lit(column).alias("ColumnName"), "DefaultRows", "RecordCount"))
    return Q.stack_rows(found)


@query("export_csv", "SELECT * FROM @Performance")
def _(t, env):
    view = V.campaign_performance(t)
    path = scratch(env, "export")
    sinks.export_csv(view, path)
    return files.scan_csv(env.spark, path, view.schema)


@query("load_row_counts", _COUNTS)
def _(t, env):
    return Q.row_counts(t, S.LOADED_TABLES)


_STATISTICS = ["customer", "orders", "lineitem", "events", "supplier"]


@query("refresh_statistics", " UNION ALL ".join(
    f"SELECT 'cartwheel_{n}' AS TableName, count(*) AS KnownRows, 'Statistics refreshed' AS Status FROM {n}" for n in _STATISTICS))
def _(t, env):
    # external tables in a database of this run's own
    database = f"cartwheel_{uuid.uuid4().hex}"
    layouts.create_database(env.spark, database)
    for name in _STATISTICS:
        env.spark.catalog.createTable(f"{database}.cartwheel_{name}", path=f"{env.folder}/{name}.parquet", source="parquet",
                                      schema=raw_table(env.spark, env.folder, name).schema)
    return sinks.refresh_statistics(env.spark, database, [f"cartwheel_{name}" for name in _STATISTICS])


# -- stored layouts ------------------------------------------------------------------

_BUCKETS = 16


def _database(t, env, store, *more):
    name = f"cartwheel_{uuid.uuid4().hex}"
    store(t, name, *more)
    return name


@query("sales_performance_bucketed", "SELECT * FROM @Sales")
def _(t, env):
    return V.sales_performance(layouts.with_stored_facts(t, _database(t, env, layouts.store_facts, _BUCKETS)))


@query("customer_metrics_bucketed", "SELECT * FROM @Analytics WHERE CustomerID = 7")
def _(t, env):
    return layouts.customer_metrics(env.spark, _database(t, env, layouts.store_by_customer, _BUCKETS), 7, as_of=ANALYTICS_AS_OF)


@query("cube_rollup", f"""SELECT CAST(SalesYear AS DOUBLE) AS SalesYear, CAST(SalesMonth AS DOUBLE) AS SalesMonth, CAST(CategoryID AS DOUBLE) AS CategoryID, {money('LineTotal', 4)} AS Revenue, CAST(sum(Quantity) AS BIGINT) AS UnitsSold, true AS CountWithinBound
    FROM @SoldLines GROUP BY ROLLUP (SalesYear, SalesMonth, CategoryID)""")
def _(t, env):
    # estimated counts against the exact ones: within four standard errors
    dims = ["SalesYear", "SalesMonth", "CategoryID"]
    cube = env.spark.table(f"{_database(t, env, layouts.store_cube)}.{layouts.CUBE}")
    exact = V.sales_rollup(t, dims).select(*[F.col(d).alias(f"_{d}") for d in dims], F.col("GroupingLevel").alias("_level"), F.col("TransactionCount").alias("_exact"))
    got = layouts.cube_rollup(cube, dims)
    same = [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in dims] + [F.col("GroupingLevel") == F.col("_level")]
    near = F.abs(F.col("TransactionCount") - F.col("_exact")) <= F.lit(4 * layouts.SKETCH_ERROR) * F.col("_exact")
    rows = got.join(exact, same, "left").select(*dims, "Revenue", "UnitsSold", near.alias("CountWithinBound"))
    return optional_numbers(rows, *dims)
