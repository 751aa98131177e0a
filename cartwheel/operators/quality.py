"""Data-quality checks.  Each check is a table of findings or a long result
(check, violations); rules over one table share one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import expr as E


def stack_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    return stack_rows(
        [tables[n].agg(F.count("*").alias("RecordCount")).select(F.lit(n).alias("TableName"), "RecordCount") for n in names]
    )


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent and the number of child rows holding each.

    Keys are counted before the join: the count runs map-side, so a key on a
    third of the rows is one row by the time it is shuffled.  NULL keys pass.
    """
    counted = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_key"))
        .agg(F.count("*").alias("Occurrences"))
    )
    known = parent.select(F.col(parent_key).alias("_parent"))
    return counted.join(known, F.col("_key") == F.col("_parent"), "left_anti")


def orphans(tables, relations: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Orphan row count per (child, key, parent, parent key); keys are integers.

    Each child and each parent is read once, whatever the number of relations:
    children are counted by (relation, key) before the shuffle, so a hot key is
    one row per task, and meet the parents' keys in one anti-join.
    """
    def names(position):
        found: dict[str, list] = {}
        for relation in relations:
            found.setdefault(relation[position], []).append(relation)
        return found

    def keys(table, own, column):
        pairs = F.array(*[F.struct(F.lit(f"{r[0]}.{r[1]}").alias("Relation"), F.col(r[column]).cast("long").alias("_key")) for r in own])
        return tables[table].select(F.explode(pairs).alias("p")).select("p.*").where("_key is not null")

    counted = stack_rows([
        keys(child, own, 1).groupBy("Relation", "_key").agg(F.count("*").alias("n")) for child, own in names(0).items()
    ])
    known = stack_rows([keys(parent, own, 3) for parent, own in names(2).items()])
    lost = counted.join(known, ["Relation", "_key"], "left_anti").groupBy("Relation").agg(F.sum("n").alias("n"))
    every = F.explode(F.array(*[F.lit(f"{r[0]}.{r[1]}") for r in relations]))
    listed = tables[relations[0][0]].sparkSession.range(1, numPartitions=1).select(every.alias("Relation"))
    return listed.join(lost, "Relation", "left").select("Relation", F.coalesce("n", F.lit(0)).alias("OrphanCount"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys on more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("Occurrences")).where("Occurrences > 1")


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Number of rows beyond the first of each key (NULL counts as one key)."""
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("DuplicateCount"))


def broken_rules(tables, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Violations per (table, rule name, condition).  A row passes while its
    condition is TRUE or NULL.  One scan per table, whatever the rule count."""
    by_table: dict[str, list[tuple[str, Column]]] = {}
    for table, name, condition in rules:
        by_table.setdefault(table, []).append((name, condition))
    results = []
    for table, checks in by_table.items():
        counts = tables[table].agg(*[F.count_if(~c).alias(n) for n, c in checks])
        results.append(_long(counts, [n for n, _ in checks], table))
    return stack_rows(results)


def null_counts(tables, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """NULLs per column, one scan per table."""
    results = []
    for table, names in columns.items():
        counts = tables[table].agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
        results.append(_long(counts, names, table))
    return stack_rows(results)


def _long(counts: DataFrame, names: Sequence[str], table: str) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("RuleName"), F.col(n).alias("Violations")) for n in names]))
    return counts.select(F.lit(table).alias("TableName"), pairs.alias("p")).select("TableName", "p.*")


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks."""
    return left.select(key).join(right.select(key), key, "left_anti")


def shared_values(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value occurs on another row too: count and percent of rows."""
    per_value = df.groupBy(column).agg(F.count("*").alias("n"))
    sharing = F.sum(F.when((F.col("n") > 1) & F.col(column).isNotNull(), F.col("n")).otherwise(0))
    return per_value.agg(sharing.alias("SharedRows"), F.sum("n").alias("TotalRows")).select(
        "SharedRows", E.percent(F.col("SharedRows"), F.col("TotalRows")).alias("SharedPct")
    )


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns holding a single value.  Smallest equals largest, so no
    distinct count is needed."""
    ends = []
    for c in columns:
        ends += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.count(c).alias(f"n_{c}")]
    flags = F.array(
        *[
            F.struct(
                F.lit(c).alias("ColumnName"),
                F.coalesce(F.col(f"lo_{c}") == F.col(f"hi_{c}"), F.lit(False)).alias("IsConstant"),
                F.col(f"n_{c}").alias("NonNullRows"),
            )
            for c in columns
        ]
    )
    return df.agg(*ends).select(F.explode(flags).alias("f")).select("f.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("Value")).agg(F.count("*").alias("RecordCount"))


def text_format_mix(df: DataFrame, column: str) -> DataFrame:
    """Rows per (length, has a space) of a code column."""
    return df.groupBy(
        F.length(column).alias("CodeLength"), F.col(column).contains(" ").alias("HasSpace")
    ).agg(F.count("*").alias("RecordCount"))


def line_arithmetic(items: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Lines whose total is not quantity * price - discount."""
    expected = F.col("Quantity") * F.col("UnitPrice") - F.col("Discount")
    return items.where(F.abs(F.col("LineTotal") - expected) > F.lit(str(tolerance)).cast("decimal(10,4)"))


def stale_age(customers: DataFrame, as_of) -> DataFrame:
    """Customers whose stored age is not their age, with an under-age flag."""
    current = E.age_years(F.col("DateOfBirth"), as_of)
    return customers.select(
        "CustomerID", "Age", current.alias("CurrentAge"), (F.col("Age") < 18).alias("StoredUnder18")
    ).where(F.col("Age") != F.col("CurrentAge"))


def profile_customer_analytics(df: DataFrame) -> DataFrame:
    """Row count, missing values per column, duplicate ids and invalid values
    of the model input, from one pass.  Only findings above 0 are listed next
    to the row and duplicate counts."""
    invalid = {
        "Age_out_of_range": ~F.col("Age").between(18, 120),
        "TotalAmountSpent_negative": F.col("TotalAmountSpent") < 0,
        "CampaignResponseRate_out_of_range": ~F.col("CampaignResponseRate").between(0, 100),
    }
    measures = [("rows", "row_count", F.count("*"))]
    # a NULL id counts as one id
    ids = F.count_distinct("CustomerID") + F.max(F.col("CustomerID").isNull().cast("int"))
    measures.append(("duplicates", "CustomerID", F.count("*") - ids))
    measures += [("missing", c, F.count_if(F.col(c).isNull())) for c in df.columns]
    measures += [("invalid", name, F.count_if(bad)) for name, bad in invalid.items()]
    counts = df.agg(*[F.coalesce(m, F.lit(0)).cast("long").alias(f"m{i}") for i, (_, _, m) in enumerate(measures)])
    rows = F.array(
        *[F.struct(F.lit(section).alias("Section"), F.lit(item).alias("Item"), F.col(f"m{i}").alias("Value"))
          for i, (section, item, _) in enumerate(measures)]
    )
    long = counts.select(F.explode(rows).alias("r")).select("r.*")
    return long.where((F.col("Value") > 0) | F.col("Section").isin("rows", "duplicates"))


def table_existence(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Expected tables, whether each is there and how many rows it has."""
    spark = next(iter(tables[n] for n in names if n in tables)).sparkSession
    results = []
    for name in names:
        present = tables.get(name)
        rows = present.agg(F.count("*").alias("n")) if present is not None else spark.range(1).select(F.lit(0).alias("n"))
        results.append(rows.select(
            F.lit(name).alias("TableName"), F.lit(present is not None).alias("Present"), (F.col("n") > 0).alias("HasRows")
        ))
    return stack_rows(results)


def compare_counts(counts: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Counted rows (TableName, RecordCount) against the expected numbers."""
    numbers = F.create_map(*[part for k, v in expected.items() for part in (F.lit(k), F.lit(v).cast("long"))])
    wanted = F.element_at(numbers, F.col("TableName"))
    return counts.select("TableName", "RecordCount", wanted.alias("Expected"),
                         (F.col("RecordCount") == wanted).alias("Matches"))
