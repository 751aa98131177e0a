"""Reading source files and stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel.operators import store
from cartwheel.operators.latest import latest_per_key
from cartwheel.sources import schemas as S

REJECTED = "_rejected"


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV as typed rows.  A malformed row fails the read instead of
    turning into NULLs; quotes follow RFC 4180 (doubled)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)  # a header that is not the schema's fails
        .csv(path)
    )


def scan_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the ten source files by name."""
    return scan_csv(spark, f"{folder}/{name}.csv", S.CSV_FILES[name])


def scan_csv_checked(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV as typed rows and ``_rejected``: the text of a line that is
    malformed or, in a column that the query uses, holds a value of another
    type; else NULL."""
    return (
        spark.read.schema(f"{schema}, {REJECTED} string")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("columnPruning", False)
        .csv(path)
    )


def rejected_lines(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Rejected lines of a source file: FileName, Line, Reason (the columns
    whose text is not of their type; else the line does not have the file's
    columns)."""
    return rejected_of(scan_csv_checked(spark, f"{folder}/{name}.csv", S.CSV_FILES[name]), name)


def rejected_of(rows: DataFrame, name: str) -> DataFrame:
    """``rejected_lines`` of the checked rows of a file."""
    fields = StructType.fromDDL(S.CSV_FILES[name]).fields
    texts = ", ".join(f"{f.name} string" for f in fields)
    parsed = F.from_csv(REJECTED, texts, {"quote": '"', "escape": '"'})
    # what the reader could not take as a column's type is NULL in its row
    wrong = [F.when(F.col(f"p.{f.name}").isNotNull() & F.col(f.name).isNull(), F.lit(f.name)) for f in fields]
    named = F.concat_ws(", ", *wrong)
    return rows.where(F.col(REJECTED).isNotNull()).withColumn("p", parsed).select(
        F.lit(name).alias("FileName"), F.col(REJECTED).alias("Line"),
        F.when(named != "", F.concat(F.lit("not of its type: "), named)).otherwise(F.lit(f"not a line of {len(fields)} columns")).alias("Reason"))


def scan_accepted(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the ten source files without its rejected lines."""
    rows = scan_csv_checked(spark, f"{folder}/{name}.csv", S.CSV_FILES[name])
    # always true, and uses every column: a line is rejected or not whichever columns a reader wants
    whole = F.xxhash64(*[c for c in rows.columns if c != REJECTED]) % 2 <= 1
    return rows.where(F.col(REJECTED).isNull() & whole).drop(REJECTED)


def accepted_of(rows: DataFrame) -> DataFrame:
    """Staged checked rows without the rejected ones: staging has parsed every
    column, so a line is rejected or not whichever columns a reader wants."""
    return rows.where(F.col(REJECTED).isNull()).drop(REJECTED)


# Texts that a data-frame CSV reader takes for missing.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def scan_csv_project(spark: SparkSession, folder: str, name: str, columns: Sequence[str]) -> DataFrame:
    """Named columns in the given order, found by the file's header in any
    order; other columns are ignored, a missing one fails.  Texts that mean
    "missing" become NULL before the cast; what then is not of the column's
    type fails the read."""
    types = {f.name: f.dataType for f in StructType.fromDDL(S.CSV_FILES[name]).fields}
    rows = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("lineSep", "\n").csv(f"{folder}/{name}.csv")
    absent = [c for c in columns if c not in rows.columns or c not in types]
    if absent:
        raise ValueError(f"{name}.csv has no column {', '.join(absent)}")

    def typed(c):
        text = F.when(~F.col(c).isin(MISSING_TEXT), F.col(c))
        value = text.try_cast(types[c])
        wrong = F.raise_error(F.concat(F.lit(f"{name}.{c}: "), text)).cast(types[c])
        return F.when(text.isNull() | value.isNotNull(), value).otherwise(wrong).alias(c)

    return rows.select(*[typed(c) for c in columns])


def stored_decisions(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """Decisions on the stored reports, one row each."""
    found = store.read_or_none(spark, path or store.table_path(spark, folder, S.DECISIONS), S.DECISION_SCHEMA)
    return empty_table(spark, S.DECISIONS) if found is None else found


def with_decisions(reports: DataFrame, decisions: DataFrame) -> DataFrame:
    """Reports with the newest decision on each as ``Approved``; without one,
    what they were stored with."""
    newest = latest_per_key(decisions, "AIReportID", "DecidedDate", "DecisionID").select("AIReportID", F.col("Approved").alias("_decided"))
    return reports.join(newest, "AIReportID", "left").withColumn("Approved", F.coalesce("_decided", "Approved")).select(*reports.columns)


def scan_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Stored table in its newest version, all columns or the named ones;
    reports as last decided on."""
    df = spark.read.parquet(store.table_path(spark, folder, name))
    if name == "AIReport" and (columns is None or "Approved" in columns):
        df = with_decisions(df, stored_decisions(spark, folder))
    return df.select(*columns) if columns else df


def scan_store(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every table of a stored load by name, all of one version; an analytic
    table that nothing was appended to yet is empty.  Reports are as last
    decided on."""
    paths, tables = store.published(spark, folder), {}

    def path(name):
        return paths.get(name, f"{folder}/{name}")

    for name in S.TABLES:
        if name in S.ANALYTIC_TABLES:
            found = store.read_or_none(spark, path(name))
            tables[name] = empty_table(spark, name) if found is None else found
        else:
            tables[name] = spark.read.parquet(path(name))
    tables["AIReport"] = with_decisions(tables["AIReport"], stored_decisions(spark, folder, path(S.DECISIONS)))
    return tables


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """An analytic table without rows."""
    return spark.createDataFrame([], {**S.ANALYTIC_TABLES, S.DECISIONS: S.DECISION_SCHEMA}[name])


def register_views(frames: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Publish DataFrames as temporary views for SQL users."""
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in frames]


def lookup_table(spark: SparkSession, names: Sequence[str], id_column: str, name_column: str) -> DataFrame:
    """Ids from 1 and names as an inline relation, whose size the planner knows."""
    quoted = [n.replace("'", "\\'") for n in names]
    entries = ", ".join(f"named_struct('{id_column}', {i}L, '{name_column}', '{n}')" for i, n in enumerate(quoted, 1))
    return spark.range(1, numPartitions=1).selectExpr(f"inline(array({entries}))")


def seed_table(spark: SparkSession, name: str) -> DataFrame:
    """A lookup table with its starting names."""
    id_column, name_column, names = S.SEEDS[name]
    return lookup_table(spark, names, id_column, name_column)
