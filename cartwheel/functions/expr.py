"""Column expressions shared by the datasets.  All of them stay inside
whole-stage code generation; none is a Python function run per row."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Ordinal of each loyalty level; any other level is 0.
LOYALTY_ORDER = {"Bronze": 1, "Silver": 2, "Gold": 3, "Platinum": 4}

# Lowest discount percent of each campaign type, highest first.
DISCOUNT_LADDER = [(30, "Deep Discount"), (15, "Standard Discount")]
ANY_DISCOUNT_TYPE = "Loyalty/Retention"
NO_DISCOUNT_TYPE = "Awareness"


def now(as_of: datetime | str | None) -> Column:
    """The moment a dataset is computed for, as a zone-less timestamp."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


# -- dates ------------------------------------------------------------------

def days_since(moment: Column, as_of) -> Column:
    """Midnights crossed between ``moment`` and ``as_of``."""
    return F.datediff(now(as_of), moment)


def age_years(birth: Column, as_of) -> Column:
    """Full years; someone born on Feb 29 has the birthday on Mar 1 in other years."""
    today = now(as_of)
    birthday_ahead = (F.month(birth) > F.month(today)) | (
        (F.month(birth) == F.month(today)) & (F.day(birth) > F.day(today))
    )
    return F.year(today) - F.year(birth) - F.when(birthday_ahead, 1).otherwise(0)


def age_at_load(birth: Column, as_of) -> Column:
    """Age as the loader stores it: whole 365-day spans since birth."""
    return F.floor(F.datediff(now(as_of), birth) / 365).cast("int")


def months_before(as_of, months: int) -> Column:
    """Same time of day, ``months`` earlier, clamped to the month's last day."""
    return now(as_of) - F.make_ym_interval(F.lit(0), F.lit(months))


# -- numbers ----------------------------------------------------------------

def money_sum(col: Column, scale: int = 2) -> Column:
    """Exact decimal sum, handed on as double (independent of row order)."""
    return F.sum(col.cast(f"decimal(18,{scale})")).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that is NULL, not an error, on a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0))


def zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def zero_f(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def half_up(col: Column, digits: int) -> Column:
    """Round half up in plain double arithmetic, for values shown to people."""
    return F.floor(col * F.lit(float(10**digits)) + F.lit(0.5)) / F.lit(float(10**digits))


# -- classification ---------------------------------------------------------

def loyalty_ordinal(level: Column) -> Column:
    ladder = reduce(
        lambda acc, item: acc.when(level == item[0], item[1]), LOYALTY_ORDER.items(), F.when(F.lit(False), 0)
    )
    return ladder.otherwise(0)


def campaign_type_name(discount_percent: Column) -> Column:
    ladder = reduce(
        lambda acc, step: acc.when(discount_percent >= step[0], step[1]), DISCOUNT_LADDER, F.when(F.lit(False), "")
    )
    return ladder.when(discount_percent > 0, ANY_DISCOUNT_TYPE).otherwise(NO_DISCOUNT_TYPE)


def yes_no(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability >= F.lit(threshold), "Yes").otherwise("No")


def prediction_correct(predicted: Column, actual: Column) -> Column:
    """True/False, or NULL while either side is unknown."""
    return F.when(predicted.isNull() | actual.isNull(), F.lit(None).cast("boolean")).otherwise(
        ((predicted == "Yes") & actual) | ((predicted == "No") & ~actual)
    )


# -- text -------------------------------------------------------------------

def lookup_key(name: Column, case_insensitive: bool = False) -> Column:
    """Key that lookup names are matched on."""
    return F.lower(F.rtrim(name)) if case_insensitive else name


def percent_text(value: Column) -> Column:
    """``12.3%``, NULL for NULL"""
    return F.when(value.isNotNull(), F.format_string("%.1f%%", half_up(value, 1)))


def dollars_text(value: Column) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(half_up(value, 2), 2))


def nonempty_text(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))
