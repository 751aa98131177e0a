"""Writing tables: full refresh, appends with ids, approval, exports.

Parquet has no in-place update.  Appends add files, also for a change of a
row, which readers resolve; loads write new versions of whole tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators import store
from cartwheel.operators.ordering import assign_ids
from cartwheel.sources import files, schemas as S


def with_defaults(df: DataFrame, table: str, as_of=None) -> DataFrame:
    """Fill missing columns and NULL values with the table's defaults."""
    for column, default in S.DEFAULTS.get(table, {}).items():
        value = E.now(as_of) if default == "now" else F.lit(default)
        if column in df.columns:
            value = F.coalesce(F.col(column), value.cast(df.schema[column].dataType))
        df = df.withColumn(column, value)
    return df


def write_table(df: DataFrame, folder: str, name: str, mode: str = "overwrite") -> None:
    """An append goes to the newest version of the table; whole tables of a
    published store are replaced by a load only."""
    path = store.table_path(df.sparkSession, folder, name) if mode == "append" else f"{folder}/{name}"
    df.write.mode(mode).parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store as a catalogued table, bucketed and sorted by ``key``.  Tables
    bucketed alike join on that key without a shuffle; for the two sales tables
    this removes the largest shuffle of every star query.

    Rows are sent to their bucket first, so that each bucket is one file.
    Unlike a shuffle, a bucket cannot be split later: keep tables with a hot
    key unbucketed.
    """
    (
        df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )


def prediction_rows(scores: DataFrame, existing: DataFrame, *, ml_model: str, model_version: str, as_of=None,
                    ) -> DataFrame:
    """Scores (CustomerID, Probability, Result) as prediction rows with ids
    after the existing ones and one timestamp for the whole run."""
    rows = scores.select(
        "CustomerID",
        E.now(as_of).alias("PredictionDate"),
        F.col("Probability").cast("decimal(5,4)").alias("PredictionProbability"),
        F.col("Result").alias("PredictionResult"),
        F.lit(ml_model).alias("MLModel"),
        F.lit(model_version).alias("ModelVersion"),
    )
    numbered = assign_ids(rows, "CustomerID", "PredictionID", existing)
    return numbered.select("PredictionID", *rows.columns)


def next_id(existing: DataFrame, id_column: str) -> Column:
    return existing.agg(F.coalesce(F.max(id_column), F.lit(0)) + 1).scalar().cast("long")


def one_row(spark: SparkSession, **values) -> DataFrame:
    return spark.range(1, numPartitions=1).select(
        *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in values.items()]
    )


def execution_row(metrics: DataFrame, existing: DataFrame, *, algorithm: str, duration_seconds: float,
                  as_of: datetime | str | None = None) -> DataFrame:
    """One model-execution row from a one-row metrics DataFrame."""
    def unit(name):
        return F.col(name).cast("decimal(5,4)")

    return metrics.select(
        next_id(existing, "ExecutionID").alias("ExecutionID"),
        E.now(as_of).alias("ExecutionDate"),
        F.lit(algorithm).alias("Algorithm"),
        unit("accuracy").alias("Accuracy"), unit("precision").alias("Precision_"), unit("recall").alias("Recall"),
        unit("f1_score").alias("F1Score"),
        F.lit(duration_seconds).cast("decimal(10,2)").alias("ExecutionDurationSeconds"),
    )


def report_rows(reports: DataFrame, existing: DataFrame, *, model_name: str, prompt_version: str, as_of=None,
                ) -> DataFrame:
    """Reports (ReportType, CampaignID, ReportText) as unapproved report rows."""
    rows = reports.select(
        "ReportType", F.col("CampaignID").cast("long").alias("CampaignID"),
        E.now(as_of).alias("GeneratedDate"),
        F.lit(model_name).alias("ModelName"), F.lit(prompt_version).alias("PromptVersion"),
        "ReportText", F.lit(False).alias("Approved"),
    )
    keyed = rows.withColumn(
        "_key", F.concat_ws("|", "ReportType", F.coalesce(F.col("CampaignID").cast("string"), F.lit("")))
    )
    return assign_ids(keyed, "_key", "AIReportID", existing).select("AIReportID", *rows.columns)


def approve_report(spark: SparkSession, folder: str, report_id: int, approve: bool = True, as_of=None) -> None:
    """Appends the decision on a stored report: one row.  Reports are never
    rewritten; readers take each report's newest decision
    (``files.with_decisions``), so one can be withdrawn by another."""
    taken = files.stored_decisions(spark, folder)
    last = taken.agg(F.coalesce(F.max("DecisionID"), F.lit(0))).first()[0]
    row = one_row(spark, DecisionID=F.lit(last + 1).cast("long"), AIReportID=F.lit(report_id).cast("long"), Approved=approve, DecidedDate=E.now(as_of))
    write_table(row, folder, S.DECISIONS, "append")


def export_csv(df: DataFrame, path: str) -> None:
    """Headered CSV, one file per partition; NULL is written as empty."""
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def refresh_statistics(spark: SparkSession, database: str, tables: list[str]) -> DataFrame:
    """Refresh optimizer statistics of catalogued tables; one status row per
    table with the row count the optimizer now knows.  With
    ``spark.sql.cbo.enabled`` and ``spark.sql.cbo.joinReorder.enabled`` it then
    orders the joins of a star by them."""
    rows = []
    for table in tables:
        spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS FOR ALL COLUMNS")
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table}").where("col_name = 'Statistics'")
        rows.append(
            detail.select(
                F.lit(table).alias("TableName"),
                F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("KnownRows"),
                F.lit("Statistics refreshed").alias("Status"),
            )
        )
    result = rows[0]
    for more in rows[1:]:
        result = result.unionByName(more)
    return result
