"""Registration of queries next to their SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.sources.bindings import bind
from registry import canon

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


@dataclass
class Env:
    spark: SparkSession
    folder: str


def plain(df: DataFrame) -> DataFrame:
    """The same rows in types both engines share: integers as bigint, decimals
    as double, dates as text, arrays as joined text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def optional_numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Integer columns that hold NULLs, as double: engines hand over missing
    integers in different ways, missing doubles alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def query(name: str, sql: str | None = None):
    """Register ``fn(tables, env)`` under a name, with SQL when there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(bind(spark, folder), Env(spark, folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = canon.sql(sql)
        return fn

    return register


def scratch(env: Env, label: str) -> str:
    """New folder in the cluster's shared scratch space."""
    from cartwheel.session import scratch_path

    return scratch_path(env.spark, label)
