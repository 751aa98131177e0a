from datetime import date, datetime

from pyspark.sql import functions as F

from cartwheel.functions import expr as E


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def birth(text):
    return F.lit(text).cast("date")


def test_age_counts_full_years(spark):
    assert one(spark, E.age_years(birth("2008-02-29"), "2026-02-28")) == 17
    assert one(spark, E.age_years(birth("2008-02-29"), "2026-03-01")) == 18
    assert one(spark, E.age_years(birth("2000-06-15"), "2020-06-15")) == 20
    assert one(spark, E.age_years(birth("2000-06-15"), "2020-06-14")) == 19


def test_age_at_load_runs_ahead_of_birthdays(spark):
    assert one(spark, E.age_at_load(birth("1960-06-15"), "2020-06-10")) == 60
    assert one(spark, E.age_years(birth("1960-06-15"), "2020-06-10")) == 59


def test_days_count_midnights(spark):
    moment = F.lit("2024-01-31 23:59:00").cast("timestamp_ntz")
    assert one(spark, E.days_since(moment, "2024-02-01 00:01:00")) == 1


def test_months_before_clamps_and_keeps_time(spark):
    assert one(spark, E.months_before("2024-08-31 10:30:00", 6)) == datetime(2024, 2, 29, 10, 30)


def test_no_as_of_means_the_clock(spark):
    assert abs((one(spark, E.now(None)) - datetime.now()).total_seconds()) < 26 * 3600


def test_ratios_are_null_on_zero(spark):
    assert one(spark, E.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, E.percent(F.lit(1), F.lit(8))) == 12.5


def test_campaign_type_ladder(spark):
    steps = {"30": "Deep Discount", "29.99": "Standard Discount", "15": "Standard Discount", "14.99": "Loyalty/Retention",
             "0.01": "Loyalty/Retention", "0": "Awareness"}
    for value, name in steps.items():
        assert one(spark, E.campaign_type_name(F.lit(value).cast("decimal(5,2)"))) == name


def test_labels(spark):
    assert one(spark, E.yes_no(F.lit(0.5))) == "Yes"
    assert one(spark, E.yes_no(F.lit(0.4999))) == "No"
    assert one(spark, E.loyalty_ordinal(F.lit("Gold"))) == 3
    assert one(spark, E.loyalty_ordinal(F.lit("gold"))) == 0
    assert one(spark, E.loyalty_ordinal(F.lit(None).cast("string"))) == 0


def test_prediction_correct_is_tristate(spark):
    def correct(said, actual):
        return one(spark, E.prediction_correct(F.lit(said).cast("string"), F.lit(actual).cast("boolean")))

    assert correct("Yes", True) is True
    assert correct("No", False) is True
    assert correct("Yes", False) is False
    assert correct(None, True) is None
    assert correct("No", None) is None


def test_text(spark):
    assert one(spark, E.percent_text(F.lit(12.345))) == "12.3%"
    assert one(spark, E.percent_text(F.lit(None).cast("double"))) is None
    assert one(spark, E.dollars_text(F.lit(1234567.5))) == "$1,234,567.50"
    assert one(spark, E.nonempty_text(F.lit("  "))) is None


def test_parse(spark):
    assert one(spark, F.to_date(F.lit("2024-02-29"))) == date(2024, 2, 29)
