"""A folder of tables whose versions are published whole.

A load writes every table to fresh paths and then appends one small file to
the version log: a row per table with its path, its rows and what was counted
while it was written.  Until that file is there, readers see the tables of the
version before; a load that breaks off leaves only unused files.  A table that
no version holds (the log of model runs) lies under its name in the folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.session import remove_path

LOG = "_versions"
DATA = "_data"
LOG_SCHEMA = ("Version bigint, LoadID string, TableName string, Path string, RecordCount bigint, Violations map<string,bigint>,"
              " PublishedAt timestamp_ntz")


@dataclass
class Written:
    """Counts of one table, gathered by its write."""

    name: str
    rows: int
    violations: dict[str, int] = field(default_factory=dict)


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table at a path, None where there is none."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def version_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per published version and table; empty for a new store."""
    log = read_or_none(spark, f"{folder}/{LOG}", LOG_SCHEMA)
    return spark.createDataFrame([], LOG_SCHEMA) if log is None else log


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The log rows of the newest version.  Loads that published the same
    number side by side: the larger load id, for all tables alike."""
    log = version_log(spark, folder)
    newest = log.agg(F.max(F.struct("Version", "LoadID"))).scalar()
    return log.where(F.struct("Version", "LoadID") == newest)


def published(spark: SparkSession, folder: str) -> dict[str, str]:
    """Path of each table of the newest version; at most one row per table of
    the model is read."""
    return {r.TableName: f"{folder}/{r.Path}" for r in current(spark, folder).select("TableName", "Path").collect()}


def table_path(spark: SparkSession, folder: str, name: str) -> str:
    return published(spark, folder).get(name, f"{folder}/{name}")


def new_load(folder: str) -> tuple[str, str]:
    """Id of a load and the folder for its tables."""
    load_id = uuid.uuid4().hex
    return load_id, f"{folder}/{DATA}/{load_id}"


def write_counted(df: DataFrame, path: str, name: str, rules: Sequence[tuple[str, Column]] = ()) -> Written:
    """Writes a table and counts its rows, and the rows that break each rule
    (condition FALSE), in the same pass."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(~c).alias(f"rule{i}") for i, (_, c) in enumerate(rules)])
    counted.write.mode("overwrite").parquet(path)
    found = seen.get
    return Written(name, found.get("rows", 0), {rule: found.get(f"rule{i}", 0) for i, (rule, _) in enumerate(rules)})


def publish(spark: SparkSession, folder: str, load_id: str, tables: Sequence[Written], as_of=None) -> DataFrame:
    """Makes the tables of a load the newest version, by one file; returns its
    log rows."""
    last = version_log(spark, folder).agg(F.coalesce(F.max("Version"), F.lit(0))).first()[0]
    rows = [(last + 1, load_id, w.name, f"{DATA}/{load_id}/{w.name}", w.rows, w.violations) for w in tables]
    frame = spark.createDataFrame(rows, LOG_SCHEMA.rpartition(",")[0]).withColumn("PublishedAt", E.now(as_of).cast("timestamp_ntz"))
    frame.coalesce(1).write.mode("append").parquet(f"{folder}/{LOG}")
    return current(spark, folder)


def row_counts(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Rows of the tables as counted when they were written; no table is read."""
    return current(spark, folder).where(F.col("TableName").isin(*names)).select("TableName", "RecordCount")


def violations(spark: SparkSession, folder: str) -> DataFrame:
    """Rule violations as counted while the newest version was written."""
    return current(spark, folder).select("TableName", F.explode("Violations").alias("RuleName", "Violations"))


def at_version(spark: SparkSession, folder: str, version: int) -> Mapping[str, DataFrame]:
    """The tables of an earlier version, while its files are kept."""
    rows = version_log(spark, folder).where(F.col("Version") == version).select("LoadID", "TableName", "Path").collect()
    chosen = max((r.LoadID for r in rows), default=None)
    return {r.TableName: spark.read.parquet(f"{folder}/{r.Path}") for r in rows if r.LoadID == chosen}


def expire(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Deletes the files of published versions but the newest ``keep``; not to be
    called while an old version is still read.  Returns the load ids."""
    loads = version_log(spark, folder).select("Version", "LoadID").distinct().orderBy(F.col("Version").desc(), F.col("LoadID").desc())
    old = [r.LoadID for r in loads.collect()[max(1, keep):]]
    for load_id in old:
        remove_path(spark, f"{folder}/{DATA}/{load_id}")
    return old
