"""Inputs of the written reports and checks of the written text.  The writing
itself is done elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators.aggregate import best_key_by_mean, rate_pct
from cartwheel.operators.latest import latest_row
from cartwheel.operators.ordering import argmax_row, median
from cartwheel.plans import views as V

PROMPT_VERSION = "v1.1"

# The headed sections of a report, in order.
SECTIONS = ["Executive Summary", "Key Findings", "Business Insights", "Marketing Recommendations", "Conclusion"]

NUMBER = r"\d[\d,]*(?:\.\d+)?"


def overall_metrics(tables) -> DataFrame:
    """One row of program totals; accuracy of the newest run, 0 without one."""
    newest = F.max_by(F.col("Accuracy").cast("double"), F.struct("ExecutionDate", "ExecutionID")) * 100.0
    customers = tables["Customer"].agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("CustomerStatus") == "Active").alias("active_customers"),
    )
    revenue = tables["SalesTransaction"].agg(E.money_sum(F.col("TransactionTotal")))
    return customers.select(
        "total_customers", "active_customers",
        tables["MarketingCampaign"].agg(F.count("*")).scalar().alias("total_campaigns"),
        E.zero_f(tables["CampaignResponse"].agg(rate_pct("PurchaseCompleted")).scalar()).alias("response_rate"),
        E.zero_f(tables["ModelExecution"].agg(newest).scalar()).alias("model_accuracy"),
        E.zero_f(revenue.scalar()).alias("total_revenue"),
    )


def latest_model_metrics(tables) -> DataFrame:
    """Newest run with the scored and positive counts over all runs."""
    scored = tables["CustomerPrediction"].agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col("PredictionResult") == "Yes").alias("yes")).alias("s")
    ).scalar()
    newest = latest_row(tables["ModelExecution"], "ExecutionDate", "ExecutionID")
    found = _required(newest, "no model run is logged: train a model first")
    return found.select(
        F.col("Algorithm").alias("algorithm"), F.col("Accuracy").cast("double").alias("accuracy"),
        F.col("Precision_").cast("double").alias("precision"), F.col("Recall").cast("double").alias("recall"),
        F.col("F1Score").cast("double").alias("f1_score"),
        scored["n"].alias("total_scored"), scored["yes"].alias("predicted_positive_count"),
    )


def _required(one_row: DataFrame, message: str) -> DataFrame:
    """A single row; the query fails with ``message`` when there is none."""
    spark = one_row.sparkSession
    found = one_row.agg(F.first(F.struct("*")).alias("row"))
    checked = F.when(F.col("row").isNull(), F.raise_error(F.lit(message)).cast(found.schema["row"].dataType))
    return found.select(checked.otherwise(F.col("row")).alias("row")).select("row.*")


def best_campaign_and_channel(tables, performance: DataFrame | None = None) -> DataFrame:
    """Best campaign and channel by completion rate and the mean discount of
    the campaigns at or above the median rate.  Campaigns never sent have no
    rate and take no part.

    Nothing is stored: the branches share the shuffle that sums the responses
    by campaign.  ``performance`` may bring a campaign performance.
    """
    if performance is None:
        performance = V.campaign_performance(tables)
    rated = performance.where("PurchaseCompletionRate is not null")
    best = _required(
        argmax_row(rated, "PurchaseCompletionRate", "CampaignID"), "no campaign was sent: load the data first"
    )
    channel = best_key_by_mean(rated, "ChannelName", "PurchaseCompletionRate").select("ChannelName").scalar()
    winners = at_least_median(rated, "PurchaseCompletionRate")
    mean_discount = E.ratio(E.money_sum(F.col("DiscountPercent")), F.count("DiscountPercent"))
    return best.select(
        F.col("CampaignName").alias("best_campaign"),
        F.col("PurchaseCompletionRate").alias("best_campaign_response_rate"),
        channel.alias("best_channel"),
        E.zero_f(winners.agg(mean_discount).scalar()).alias("avg_discount_on_winners"),
    )


def at_least_median(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) >= median(df, column).scalar())


def top_campaign(tables, *, campaign_id=None) -> DataFrame:
    """Campaign with the highest revenue, or the given one; fails if there is none."""
    performance = V.campaign_performance(tables, campaign_id=campaign_id)
    return _required(
        argmax_row(performance, "TotalRevenueGenerated", "CampaignID"), f"no campaign found for id {campaign_id}"
    )


# -- prompts -------------------------------------------------------------------

_CLOSING = (
    "Answer in five headed sections, in this order: " + ", ".join(SECTIONS) + ". "
    "Use only the figures above. Name no period of time that is not given above. "
    "Write in a professional tone, in fewer than 400 words."
)


def _prompt(intro: str, *lines, closing: str = _CLOSING):
    """intro, one bullet per (label, text column), closing."""
    bullets = [F.concat(F.lit(f"- {label}: "), F.coalesce(value, F.lit("n/a"))) for label, value in lines]
    return F.concat_ws("\n", F.lit(intro), *bullets, F.lit(closing))


def _text(name):
    return F.col(name).cast("string")


def _pct(name, scale=1.0):
    return E.percent_text(F.col(name) * F.lit(scale))


def campaign_prompts(performance: DataFrame) -> DataFrame:
    """The campaign analysis prompt of every campaign, as (CampaignID, Prompt)."""
    prompt = _prompt(
        "Explain the performance of this retail marketing campaign.",
        ("Campaign", F.concat(F.col("CampaignName"), F.lit(" via "), F.col("ChannelName"))),
        ("Discount offered", F.concat(F.col("DiscountPercent").cast("decimal(5,2)").cast("string"), F.lit("%"))),
        ("Customers contacted", _text("CustomersContacted")),
        ("Open rate", _pct("OpenRate")),
        ("Completed purchases", _pct("PurchaseCompletionRate")),
        ("Revenue", E.dollars_text(F.col("TotalRevenueGenerated"))),
        ("Average purchase", E.dollars_text(F.col("AveragePurchaseAmount"))),
    )
    return performance.select("CampaignID", prompt.alias("Prompt"))


def _typed_prompts(row: DataFrame, prompts: dict) -> DataFrame:
    """One output row per prompt, all from the same input row."""
    entries = F.array(*[F.struct(F.lit(k).alias("ReportType"), p.alias("Prompt")) for k, p in prompts.items()])
    return row.select(F.explode(entries).alias("p")).select(
        "p.ReportType", F.lit(None).cast("long").alias("CampaignID"), "p.Prompt"
    )


def prompts_batch(tables) -> DataFrame:
    """All prompts at once: one per campaign, one of each other type."""
    performance = V.campaign_performance(tables)
    model = latest_model_metrics(tables)
    program = [
        ("Total customers", _text("total_customers")),
        ("Campaign response rate", _pct("response_rate")),
        ("Prediction accuracy", _pct("model_accuracy")),
        ("Total revenue", E.dollars_text(F.col("total_revenue"))),
    ]
    program_prompts = _typed_prompts(overall_metrics(tables), {
        SECTIONS[0]: _prompt(
            "Summarise the state of this retail campaign program.", *program,
            ("Active customers", _text("active_customers")), ("Campaigns", _text("total_campaigns")),
        ),
        "Dashboard Commentary": _prompt(
            "Write a comment of under 150 words for a store manager who looks at a dashboard with these figures.",
            *program,
        ),
    })
    advice = best_campaign_and_channel(tables, performance).select(F.struct("*")).scalar()
    model_prompts = _typed_prompts(model.withColumn("_advice", advice).select("*", "_advice.*"), {
        "Prediction Interpretation": _prompt(
            "Explain in plain words what this model can and cannot do for the next campaign.",
            ("Model", F.col("algorithm")), ("Accuracy", _pct("accuracy", 100.0)),
            ("Precision", _pct("precision", 100.0)), ("Recall", _pct("recall", 100.0)),
            ("F1", _pct("f1_score", 100.0)),
            ("Predicted responders", F.concat(_text("predicted_positive_count"), F.lit(" of "), _text("total_scored"))),
        ),
        "Business Recommendations": _prompt(
            "Recommend targeting, channel and discount for the coming campaigns.",
            ("Best channel", F.col("best_channel")), ("Best campaign", F.col("best_campaign")),
            ("Its response rate", _pct("best_campaign_response_rate")),
            ("Predicted responders", _text("predicted_positive_count")),
            ("Mean discount of successful campaigns", _pct("avg_discount_on_winners")),
        ),
    })
    campaigns = campaign_prompts(performance).select(F.lit("Campaign Analysis").alias("ReportType"), "CampaignID", "Prompt")
    return campaigns.unionByName(program_prompts).unionByName(model_prompts)


# -- checks of written reports ---------------------------------------------------

def sections_check(reports: DataFrame) -> DataFrame:
    """Per report: has text, names all five sections, names them in order."""
    body = F.trim("ReportText")
    spots = [F.locate(section, F.col("ReportText")) for section in SECTIONS]
    present = spots[0] > 0
    ordered = spots[0] > 0
    for before, after in zip(spots, spots[1:]):
        present = present & (after > 0)
        ordered = ordered & (after > before)
    return reports.select(
        "AIReportID",
        F.coalesce(F.length(body) > 0, F.lit(False)).alias("HasText"),
        F.coalesce(present, F.lit(False)).alias("HasSections"),
        F.coalesce(ordered, F.lit(False)).alias("InOrder"),
    )


def _numbers(text):
    """Distinct numbers of a text by value: thousands separators and zeros at the
    end of a fraction make no difference.  A number too long for the type is
    left out."""
    found = F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0))
    values = F.transform(found, lambda n: F.regexp_replace(n, ",", "").try_cast("decimal(38,6)"))
    return F.array_distinct(F.filter(values, lambda n: n.isNotNull()))


def _shown(number):
    """A number without zeros at the end of its fraction."""
    return F.regexp_replace(F.regexp_replace(number.cast("string"), r"0+$", ""), r"\.$", "")


def number_check(reports: DataFrame, inputs: DataFrame, key: str) -> DataFrame:
    """Numbers of each report that its input (``key``, Prompt) lacks; every
    report without an input has none to lean on."""
    # pulling the numbers out first keeps the long texts out of the shuffle
    said = reports.select("AIReportID", key, _numbers(F.col("ReportText")).alias("_said"))
    given = inputs.select(key, _numbers(F.col("Prompt")).alias("_given"))
    # reports without a key stay out of the join: they would all meet in one task
    keyed = said.where(F.col(key).isNotNull()).join(given, key, "left")
    unkeyed = said.where(F.col(key).isNull()).withColumn("_given", F.lit(None).cast("array<decimal(38,6)>"))
    missing = F.array_except("_said", F.coalesce(F.col("_given"), F.array().cast("array<decimal(38,6)>")))
    return keyed.unionByName(unkeyed).select(
        "AIReportID", F.size("_said").alias("NumbersFound"),
        F.array_sort(F.transform(missing, _shown)).alias("UnsupportedNumbers"),
    )
