"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, moment: str, tie: str) -> DataFrame:
    """Whole newest row of each key; equal moments are decided by ``tie``.

    The filter on the row number becomes a WindowGroupLimit, which keeps one
    row per key and task before the shuffle, so a hot key never piles up.
    """
    newest = Window.partitionBy(key).orderBy(F.col(moment).desc(), F.col(tie).desc())
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def latest_value(column: str | Column, moment: str, tie: str) -> Column:
    """Aggregate form: the newest value, combined map-side like any other
    aggregate, for use next to counts and sums over the same key."""
    return F.max_by(column, F.struct(moment, tie))


# A moment, an id and a flag as one number: microseconds since year 1, then 19
# digits of the id, then one digit of the flag.
_EPOCH = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def latest_flag(column: str, moment: str, tie: str) -> Column:
    """The newest value of a boolean column, NULL included, as the maximum of a
    fixed-width number: unlike ``max_by`` of a struct it stays in a hash
    aggregate, without a sort of the rows.  Ids are not negative; a row without
    a moment counts as the oldest."""
    micros = F.coalesce(F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{moment}`)"), F.lit(0))
    digit = F.coalesce(F.col(column).cast("int") + 1, F.lit(0))
    # joined as digits: the widths are fixed, so no arithmetic can overflow
    packed = F.concat(micros.cast("string"), F.lpad(F.col(tie).cast("string"), 19, "0"), digit.cast("string")).cast("decimal(38,0)")
    newest = (F.max(packed) % 10).cast("int")
    return F.when(newest > 0, newest == 2)


def latest_row(df: DataFrame, moment: str, tie: str) -> DataFrame:
    """The newest row of the whole table."""
    return df.orderBy(F.col(moment).desc(), F.col(tie).desc()).limit(1)
