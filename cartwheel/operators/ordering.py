"""Top-k, global ranks, exact quantiles and gap-free ids.

A window without PARTITION BY moves a whole table into one task.  The
functions here give the same answers from windows over bounded buckets: rows
go to buckets in rank order, one small aggregate counts the rows ahead of each
bucket, and positions inside a bucket are added to that count.

Where buckets of values begin comes from a mergeable quantile sketch.  For a
quantile the sketch also tells between which two values it must lie; only
values in that bracket are sorted, all others are just counted.  Nothing is
stored: the input is read by the sketch and once more for the exact answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per ordering.  The windows over bucket totals hold at most this many
# rows (times the number of groups), whatever the size of the table.
VALUE_BUCKETS = 1024  # a power of two
SKETCH_SIZE = 4096  # values a sketch keeps in its largest level: about 100 kB
# Published bound of such a sketch: its rank error is below this share of the
# rows with 99 % confidence.  A bracket is four times as wide.
RANK_ERROR = 2.296 / SKETCH_SIZE**0.9021
BRACKET_STEPS = 63  # buckets of a bracket
HASH_DIGITS = 3  # 16 ** 3 buckets


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows; the caller ends ``order`` with a unique key."""
    return df.orderBy(*order).limit(k)


def top_k_ranked(df: DataFrame, k: int, metric: str, tie: str, rank: str) -> DataFrame:
    """Top k by ``metric`` with RANK().  A rank depends only on the rows
    ahead, so ranking the k rows gives the global rank."""
    best = top_k(df, k, F.col(metric).desc(), F.col(tie).asc())
    return best.withColumn(rank, F.rank().over(Window.orderBy(F.col(metric).desc())))


def argmax_row(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """Row with the largest non-NULL metric, smallest ``tie`` first."""
    return top_k(df.where(F.col(metric).isNotNull()), 1, F.col(metric).desc(), F.col(tie).asc())


def _with_offset(totals: DataFrame, groups: Sequence[str], descending: bool = False) -> DataFrame:
    """Rows ahead of each bucket and rows of the group, from one row per bucket."""
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    group = Window.partitionBy(*groups)
    ahead = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *groups, "_bucket", "_total",
        F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_offset"),
        F.sum("_total").over(group).alias("size"),
    )


def _with_bucket(df: DataFrame, value: Column, cuts: str, count: int) -> DataFrame:
    """Adds the number of cut points below the value, by binary search in the
    sorted array of up to ``count``: one generated projection per halving."""
    df = df.withColumns({"_bucket": F.lit(0), "_spot": value})
    step = 1 << max(count, 1).bit_length() - 1
    while step:
        below = F.get(cuts, F.col("_bucket") + F.lit(step - 1)) < F.col("_spot")
        df = df.withColumn("_bucket", F.col("_bucket") + F.when(below, step).otherwise(0))
        step //= 2
    return df.drop("_spot")


def _known(df: DataFrame, value: str) -> DataFrame:
    """Rows with a value; a double that is not a number counts as none."""
    rows = df.where(F.col(value).isNotNull())
    return rows.where(~F.isnan(value)) if df.schema[value].dataType.typeName() in ("double", "float") else rows


def _sketch(value: str) -> Column:
    return F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_SIZE))


def _at_ranks(sketch: str, ranks: Sequence[float]) -> Column:
    """Sorted values of a sketch at these shares of the rows, which go to the
    parser as one text: a call per literal would take longer than the query."""
    listed = ", ".join(f"{min(max(r, 0.0), 1.0):.12f}D" for r in ranks)
    return F.expr(f"array_sort(kll_sketch_get_quantile_double({sketch}, array({listed})))")


def _positions(counted: DataFrame, value: str, groups: Sequence[str], descending: bool = False) -> DataFrame:
    """Adds ``ahead`` (rows before) and ``size`` (rows in all) to rows (groups,
    _bucket, value, n).  A NULL value stands for the other rows of its bucket,
    which come first."""
    order = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_first()
    totals = counted.groupBy(*groups, "_bucket").agg(F.sum("n").alias("_total"))
    offsets = _with_offset(totals, groups, descending).drop("_total")
    inside = Window.partitionBy(*groups, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counted.join(offsets, [*groups, "_bucket"]).select(
        *groups, value, "n", "size", (F.col("_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("ahead")
    )


def value_positions(df: DataFrame, value: str, descending: bool = False) -> DataFrame:
    """Distinct non-NULL values with ``n`` (rows holding the value), ``ahead``
    (rows before it in the order) and ``size`` (rows in all).

    Equal values are counted first, so that a value that fills a third of the
    table is a single row; the sketch is taken of the distinct values.
    """
    counted = _known(df, value).groupBy(value).agg(F.count("*").alias("n"))
    spots = [i / VALUE_BUCKETS for i in range(1, VALUE_BUCKETS)]
    sketch = counted.agg(_sketch(value).alias("_sketch"), F.count("*").alias("_rows")).where("_rows > 0")
    cuts = sketch.select(_at_ranks("_sketch", spots).alias("_cuts")).scalar()
    placed = _with_bucket(counted.withColumn("_cuts", cuts), F.col(value).cast("double"), "_cuts", len(spots)).drop("_cuts")
    return _positions(placed, value, [], descending)


def global_rank(df: DataFrame, metric: str, rank: str) -> DataFrame:
    """RANK() OVER (ORDER BY metric DESC) on every row of a table of any size;
    rows with a NULL metric come last.

    The ranks of the distinct values are joined back (hot values are split by
    AQE).
    """
    positions = value_positions(df, metric, descending=True)
    known = df.where(F.col(metric).isNotNull()).join(
        positions.select(metric, (F.col("ahead") + 1).alias(rank)), metric
    )
    n_known = df.agg(F.count(metric)).scalar()
    unknown = df.where(F.col(metric).isNull()).withColumn(rank, n_known + 1)
    return known.unionByName(unknown).select(*df.columns, rank)


def _quantile_ranks(p: float) -> tuple[Column, Column]:
    """Zero-based positions on both sides of a quantile, given ``size``."""
    spot = (F.col("size") - 1) * F.lit(float(p))
    return F.floor(spot), F.ceil(spot)


def _brackets(probabilities: Sequence[float]) -> list[Column]:
    """Columns ``_low``, ``_high`` (a value each per probability) and ``_cuts`` (their
    buckets' ends) of a row with ``_sketch`` and ``_rows``.  Few rows are all
    in the bracket."""
    few, spread = F.col("_rows") <= SKETCH_SIZE, 4 * RANK_ERROR
    lows, highs, cuts = [], [], []
    for p in probabilities:
        ends = _at_ranks("_sketch", [p - spread, p + spread])
        lows.append(F.when(few | F.lit(p <= spread), F.lit(float("-inf"))).otherwise(F.element_at(ends, 1)))
        highs.append(F.when(few | F.lit(p >= 1 - spread), F.lit(float("inf"))).otherwise(F.element_at(ends, 2)))
        cuts += [p - spread + 2 * spread * i / BRACKET_STEPS for i in range(BRACKET_STEPS + 1)]
    return [F.array(*lows).alias("_low"), F.array(*highs).alias("_high"), _at_ranks("_sketch", cuts).alias("_cuts")]


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float], groups: Sequence[str] = (),
                    sketches: DataFrame | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles, one column ``q0, q1, ..`` per
    probability and one row per group with a value (without groups always one
    row, of NULLs for an empty column).  ``groups`` must be few (feature names,
    not keys).

    Two reads of ``df``: a sketch per group (``sketches``, with ``_sketch`` and
    ``_rows``, if the caller has them) and the counts.  Values in a bracket
    around a quantile, four rank errors of the sketch to both sides, are
    counted one by one, the rest bucket by bucket.  Should a quantile ever lie
    outside its bracket, the query fails rather than give another value.
    """
    groups = list(groups)
    known = _known(df, value)
    if sketches is None:
        sketches = known.groupBy(*groups).agg(_sketch(value).alias("_sketch"), F.count("*").alias("_rows"))
    bounds = sketches.where("_rows > 0").select(*groups, *_brackets(probabilities))
    if groups:  # one row per group
        placed = known.select(*groups, value).join(bounds, groups)
    else:
        placed = known.select(value).withColumn("_b", bounds.agg(F.first(F.struct("_low", "_high", "_cuts"))).scalar()).select(value, "_b.*")
    spot, near = F.col(value).cast("double"), F.lit(False)
    for i in range(len(probabilities)):
        near = near | spot.between(F.get("_low", F.lit(i)), F.get("_high", F.lit(i)))
    placed = _with_bucket(placed.withColumn("_near", near), spot, "_cuts", len(probabilities) * (BRACKET_STEPS + 1))
    counted = placed.groupBy(*groups, "_bucket", F.when(F.col("_near"), F.col(value)).alias(value)).agg(F.count("*").alias("n"))
    positions = _positions(counted, value, groups)

    def at(rank: Column) -> Column:
        here = (F.col("ahead") <= rank) & (rank < F.col("ahead") + F.col("n"))
        found = F.max(F.when(here, F.col(value).cast("double")))
        outside = F.raise_error(F.lit(f"a quantile of {value} lies outside its bracket")).cast("double")
        return F.when(F.max("size").isNull(), F.lit(None)).otherwise(F.coalesce(found, outside))

    columns = []
    for i, p in enumerate(probabilities):
        below, above = _quantile_ranks(p)
        low, high = at(below), at(above)
        share = F.max((F.col("size") - 1) * F.lit(float(p)) - below)
        columns.append((low + (high - low) * share).alias(f"q{i}"))
    return positions.groupBy(*groups).agg(*columns)


def median(df: DataFrame, value: str) -> DataFrame:
    """Exact median of a column of any cardinality, as one row ``q0``."""
    return exact_quantiles(df, value, [0.5])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column.  The same
    pass that counts and sums takes the sketches of the quartiles."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    long = df.select(pairs.alias("p")).select("p.*")
    base = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        _sketch("value").alias("_sketch"),
    )
    quartiles = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"],
                                base.select("feature", "_sketch", F.col("count").alias("_rows")))
    return base.join(quartiles, "feature", "left").select(
        "feature", "count", "mean", "std", "min",
        F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max",
    )


def hash_positions(df: DataFrame, hashed: Column, position: str, groups: Sequence[str] = (),
                   size: str | None = None) -> DataFrame:
    """Gap-free positions 1..n per group in the order of ``hashed`` (an md5
    text of a unique key); with ``size``, also n.

    The first hex digits spread the rows evenly whatever the keys look like,
    so each window partition holds about 1/4096 of a group.
    """
    groups = list(groups)
    hashed_rows = df.withColumn("_hash", hashed).withColumn("_bucket", F.substring("_hash", 1, HASH_DIGITS))
    totals = hashed_rows.groupBy(*groups, "_bucket").agg(F.count("*").alias("_total"))
    offsets = _with_offset(totals, groups).drop("_total")
    offsets = offsets.withColumnRenamed("size", size) if size else offsets.drop("size")
    inside = Window.partitionBy(*groups, "_bucket").orderBy("_hash")
    # offsets: at most 4096 rows per group
    return (
        hashed_rows.join(offsets, [*groups, "_bucket"])
        .withColumn(position, F.col("_offset") + F.row_number().over(inside))
        .drop("_hash", "_bucket", "_offset")
    )


def assign_ids(df: DataFrame, key: str, id_column: str, taken: DataFrame | None = None) -> DataFrame:
    """Give every row of unique ``key`` the next free id after the ids in
    ``taken`` (stable: the order is the md5 of the key)."""
    numbered = hash_positions(df, F.md5(F.col(key).cast("string")), id_column)
    if taken is None:
        return numbered
    highest = taken.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    return numbered.withColumn(id_column, F.col(id_column) + highest)
