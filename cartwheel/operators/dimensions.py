"""Lookup tables: add what is missing, replace names by ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators.ordering import assign_ids


def distinct_names(stage: DataFrame, text: str, case_insensitive: bool = False) -> DataFrame:
    """Distinct non-NULL lookup values.  With ``case_insensitive`` the
    alphabetically first spelling stands for all spellings of a name."""
    names = stage.select(F.col(text).alias("_name")).where("_name is not null")
    if not case_insensitive:
        return names.distinct()
    key = E.lookup_key(F.col("_name"), True)
    return names.groupBy(key.alias("_key")).agg(F.min("_name").alias("_name")).select("_name")


def missing_names(stage, text, dim, name, case_insensitive: bool = False) -> DataFrame:
    """Names in the staged rows that the lookup table does not hold yet."""
    seen = dim.select(E.lookup_key(F.col(name), case_insensitive).alias("_key"))
    candidates = distinct_names(stage, text, case_insensitive)
    return candidates.join(seen, E.lookup_key(F.col("_name"), case_insensitive) == F.col("_key"), "left_anti").select(
        F.col("_name").alias(name)
    )


def upsert_missing(stage, text, dim, name, id_column, case_insensitive: bool = False) -> DataFrame:
    """The lookup table with missing names appended; existing ids stay."""
    added = assign_ids(missing_names(stage, text, dim, name, case_insensitive), name, id_column, dim)
    kept = dim.select(F.col(id_column).cast("long").alias(id_column), name)
    return kept.unionByName(added.select(F.col(id_column).cast("long").alias(id_column), name))


def resolve_key(fact, text, dim, name, id_column, case_insensitive: bool = False) -> DataFrame:
    """Replace a lookup text by the id of its name.  Rows whose text is in no
    lookup row drop out, as with any inner join."""
    keys = dim.select(E.lookup_key(F.col(name), case_insensitive).alias("_key"), id_column)
    return fact.join(keys, E.lookup_key(F.col(text), case_insensitive) == F.col("_key")).drop("_key", text)


def resolve_campaign_type(campaigns: DataFrame, types: DataFrame) -> DataFrame:
    """Campaign type id from the discount percent."""
    named = campaigns.withColumn("_type", E.campaign_type_name(F.col("DiscountPercent")))
    return resolve_key(named, "_type", types, "TypeName", "CampaignTypeID")
