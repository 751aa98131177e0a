"""Features, model, scoring, report inputs, generated data."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from cartwheel.operators import sinks
from cartwheel.plans import learning as L
from cartwheel.plans import reports as R
from cartwheel.plans import views as V
from cartwheel.session import materialize, scratch_root
from cartwheel.sources import bindings, files, generate, schemas as S
from cartwheel.sources.bindings import ANALYTICS_AS_OF
from registry.canon import count_if, dollars_text, half_up, money, pct, percent_text, ratio
from registry.core import optional_numbers, query, scratch
from registry.storage import _ACCURACY, _CELLS, _F1, _PRECISION, _RECALL, judged

c = F.col


def analytics(t):
    return V.customer_analytics(t, as_of=ANALYTICS_AS_OF)


def stored_analytics(t):
    """The view written once: training, its split and scoring all read it."""
    return materialize(analytics(t), "analytics")


_MATRIX = "CustomerID, " + ", ".join(L.FEATURES)

# -- preparation --------------------------------------------------------------------


@query("features", f"SELECT {_MATRIX}, label FROM @Features WHERE label IS NOT NULL")
def _(t, env):
    return L.features(analytics(t))


@query("impute_recency_sentinel", f"SELECT CustomerID, DaysSinceLastPurchase FROM @Features")
def _(t, env):
    return L.impute_recency(analytics(t)).select("CustomerID", "DaysSinceLastPurchase")


@query("impute_zero", """SELECT c.CustomerID, coalesce(r.n, 0) AS NumCampaignsReceived, coalesce(t.total, 0.0) AS TotalAmountSpent
    FROM @Customer c LEFT JOIN (SELECT CustomerID, count(*) AS n FROM @CampaignResponse GROUP BY 1) r ON r.CustomerID = c.CustomerID
    LEFT JOIN (SELECT CustomerID, CAST(sum(TransactionTotal) AS DOUBLE) AS total FROM @SalesTransaction GROUP BY 1) t ON t.CustomerID = c.CustomerID""")
def _(t, env):
    # the gaps of the raw left joins, before the view fills them
    gaps = analytics(t).select("CustomerID", *[
        F.when(c(n) != 0, c(n)).alias(n) if n in ("NumCampaignsReceived", "TotalAmountSpent") else c(n) for n in L.ZERO_FILLED
    ])
    return L.impute_zero(gaps).select("CustomerID", "NumCampaignsReceived", "TotalAmountSpent")


@query("label_balance", f"""SELECT count(label) AS LabelledRows, count(*) - count(label) AS DroppedRows,
    {ratio(count_if('label = 1'), 'count(label)')} AS PositiveRate FROM @Features""")
def _(t, env):
    return L.label_balance(analytics(t))


@query("drop_unlabelled", "SELECT CustomerID, PurchaseCompleted FROM @Analytics WHERE PurchaseCompleted IS NOT NULL")
def _(t, env):
    return L.drop_unlabelled(analytics(t)).select("CustomerID", "PurchaseCompleted")


_SPLIT = """SELECT CustomerID, label, row_number() OVER (PARTITION BY label ORDER BY md5(CustomerID || '|42')) <= floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5) AS is_test
    FROM @Features WHERE label IS NOT NULL"""


@query("stratified_split", _SPLIT)
def _(t, env):
    return L.stratified_split(L.features(analytics(t))).select("CustomerID", "label", "is_test")


@query("class_weights", """SELECT label, n, CAST(sum(n) OVER () AS DOUBLE) / CAST(count(*) OVER () * n AS DOUBLE) AS weight
    FROM (SELECT label, count(*) AS n FROM @Features WHERE label IS NOT NULL GROUP BY 1) x""")
def _(t, env):
    return L.class_weights(L.features(analytics(t)))


# -- model ------------------------------------------------------------------------------

def _models(env):
    """Folder of the models trained on a folder of tables, in the shared space:
    a model outlives the session that trained it."""
    return f"{scratch_root(env.spark)}/response_models/{hashlib.md5(env.folder.encode()).hexdigest()}"


def _split(t):
    return L.stratified_split(L.features(analytics(t)))


def train(t, env, rows=None):
    rows = stored_analytics(t) if rows is None else rows
    split = materialize(L.stratified_split(L.features(rows)), "split")
    return L.train_random_forest(split.where("not is_test"), _models(env), as_of=ANALYTICS_AS_OF)


def stored_model(t, env, rows=None):
    """The stored model; trained first where there is none, on ``rows`` where
    the caller has the analytics stored."""
    try:
        return L.load_model(env.spark, _models(env))
    except LookupError:
        return train(t, env, rows)


def scores(t, env):
    rows = stored_analytics(t)
    return L.score_all(stored_model(t, env, rows), L.features(rows, for_training=False))


@query("train_random_forest", """SELECT CAST(sum(n - floor(n * 0.2 + 0.5)) AS BIGINT) AS TrainRows, CAST(200 AS BIGINT) AS Trees, CAST(10 AS BIGINT) AS Features,
    true AS DepthHeld, CAST(0.5 AS DOUBLE) AS Threshold, true AS Timed
    FROM (SELECT label, count(*) AS n FROM @Features WHERE label IS NOT NULL GROUP BY 1) x""")
def _(t, env):
    # trained and stored here, then read back
    model = L.load_model(env.spark, _models(env), train(t, env).model_id)
    return env.spark.range(1).select(
        F.lit(model.train_rows).alias("TrainRows"), F.lit(model.forest.getNumTrees).alias("Trees"),
        F.lit(model.forest.numFeatures).alias("Features"), F.lit(max(x.depth for x in model.forest.trees) <= L.FOREST["maxDepth"]).alias("DepthHeld"),
        F.lit(model.threshold).alias("Threshold"), F.lit(model.seconds > 0).alias("Timed"),
    )


@query("feature_importance")
def _(t, env):
    return L.feature_importance(stored_model(t, env), env.spark)


@query("feature_importance_sums", "SELECT CAST(10 AS BIGINT) AS Features, true AS NonNegative, true AS SumsToOne")
def _(t, env):
    named = L.feature_importance(stored_model(t, env), env.spark)
    return named.agg(F.count_distinct("Feature").alias("Features"), (F.min("Importance") >= 0).alias("NonNegative"),
                     (F.abs(F.sum("Importance") - 1) < 1e-9).alias("SumsToOne"))


@query("test_confusion_sums", """SELECT CAST(sum(floor(n * 0.2 + 0.5)) AS BIGINT) AS TestRows, CAST(sum(CASE WHEN label = 1 THEN floor(n * 0.2 + 0.5) END) AS BIGINT) AS Positive
    FROM (SELECT label, count(*) AS n FROM @Features WHERE label IS NOT NULL GROUP BY 1) x""")
def _(t, env):
    # counts of the stored model's own predictions on the test rows
    judged = L.evaluate_classifier(L.predict(stored_model(t, env), _split(t).where("is_test")))
    return judged.select((c("tn") + c("fp") + c("fn") + c("tp")).alias("TestRows"), (c("fn") + c("tp")).alias("Positive"))


_METRICS = f"SELECT tn, fp, fn, tp, {_ACCURACY} AS accuracy, {_PRECISION} AS precision, {_RECALL} AS recall, {_F1} AS f1_score FROM {_CELLS}"


@query("evaluate_classifier", _METRICS)
def _(t, env):
    return L.evaluate_classifier(judged(t))


@query("evaluation_text", f"""SELECT 'accuracy' AS Metric, {percent_text('accuracy * 100.0')} || ' of the customers were classified correctly.' AS Sentence FROM ({_METRICS}) m
    UNION ALL SELECT 'precision', {percent_text('precision * 100.0')} || ' of the customers predicted to respond did respond; the rest is spend on customers who do not buy.' FROM ({_METRICS}) m
    UNION ALL SELECT 'recall', {percent_text('recall * 100.0')} || ' of the customers who respond were found; the others are missed opportunities.' FROM ({_METRICS}) m
    UNION ALL SELECT 'f1_score', printf('The balance of precision and recall (F1) is %.3f.', {half_up('f1_score', 3)}) FROM ({_METRICS}) m
    UNION ALL SELECT 'confusion_matrix', printf('%d true negatives, %d false positives, %d false negatives, %d true positives.', tn, fp, fn, tp) FROM ({_METRICS}) m""")
def _(t, env):
    return L.evaluation_text(L.evaluate_classifier(judged(t)))


@query("score_all")
def _(t, env):
    return scores(t, env)


@query("score_all_rules", "SELECT CustomerID, true AS InRange, true AS LabelFollows FROM @Customer")
def _(t, env):
    # every customer once, a probability, and the label that follows from it
    scored = scores(t, env)
    return scored.select("CustomerID", c("Probability").between(0, 1).alias("InRange"),
                         ((c("Probability") >= 0.5) == (c("Result") == "Yes")).alias("LabelFollows"))


@query("store_scores", """SELECT (SELECT count(*) FROM @CustomerPrediction) + 2 * (SELECT count(*) FROM @Customer) AS Predictions,
    (SELECT count(*) FROM @CustomerPrediction) + 2 * (SELECT count(*) FROM @Customer) AS Ids, (SELECT count(*) FROM @ModelExecution) + 1 AS Executions,
    (SELECT CAST(max(PredictionID) AS BIGINT) FROM @CustomerPrediction) + 2 * (SELECT count(*) FROM @Customer) AS LastID, (SELECT count(*) FROM @Customer) AS Agreeing""")
def _(t, env):
    # one run that trains, one that loads what was stored and scores again
    folder = scratch(env, "scores")
    for name in S.TABLES:
        sinks.write_table(t[name], folder, name)
    L.train_and_store(env.spark, folder, as_of=ANALYTICS_AS_OF)
    L.score_and_store(env.spark, folder, as_of=ANALYTICS_AS_OF)
    stored = files.scan_table(env.spark, folder, "CustomerPrediction")
    runs = files.scan_table(env.spark, folder, "ModelExecution")
    known = t["CustomerPrediction"].agg(F.max("PredictionID")).scalar()
    same = stored.where(c("PredictionID") > known).groupBy("CustomerID").agg(
        (F.count_distinct("PredictionProbability", "PredictionResult") == 1).alias("same")).agg(F.count_if("same")).scalar()
    return stored.agg(F.count("*").alias("Predictions"), F.count_distinct("PredictionID").alias("Ids"), F.max("PredictionID").alias("LastID")).select(
        "Predictions", "Ids", runs.agg(F.count("*")).scalar().alias("Executions"), "LastID", same.alias("Agreeing")
    )


@query("score_summary", f"""SELECT count(*) AS Scored, {count_if("PredictionResult = 'Yes'")} AS PredictedYes,
    {pct(count_if("PredictionResult = 'Yes'"), 'count(*)')} AS PredictedYesPct FROM @CustomerPrediction""")
def _(t, env):
    return L.score_summary(t["CustomerPrediction"].select(c("PredictionResult").alias("Result")))


# -- report inputs ------------------------------------------------------------------------

_OVERALL = f"""SELECT (SELECT count(*) FROM @Customer) AS total_customers, (SELECT count(*) FROM @Customer WHERE CustomerStatus = 'Active') AS active_customers,
    (SELECT count(*) FROM @MarketingCampaign) AS total_campaigns, (SELECT {pct(count_if('PurchaseCompleted'), 'count(*)')} FROM @CampaignResponse) AS response_rate,
    (SELECT CAST(Accuracy AS DOUBLE) * 100.0 FROM @ModelExecution ORDER BY ExecutionDate DESC, ExecutionID DESC LIMIT 1) AS model_accuracy,
    (SELECT {money('TransactionTotal')} FROM @SalesTransaction) AS total_revenue"""
_LATEST_MODEL = f"""SELECT Algorithm AS algorithm, CAST(Accuracy AS DOUBLE) AS accuracy, CAST(Precision_ AS DOUBLE) AS precision, CAST(Recall AS DOUBLE) AS recall,
    CAST(F1Score AS DOUBLE) AS f1_score, (SELECT count(*) FROM @CustomerPrediction) AS total_scored,
    (SELECT {count_if("PredictionResult = 'Yes'")} FROM @CustomerPrediction) AS predicted_positive_count
    FROM @ModelExecution ORDER BY ExecutionDate DESC, ExecutionID DESC LIMIT 1"""
_BEST = f"""SELECT CampaignName AS best_campaign, PurchaseCompletionRate AS best_campaign_response_rate,
    (SELECT ChannelName FROM @Performance WHERE PurchaseCompletionRate IS NOT NULL GROUP BY 1 ORDER BY CAST(sum(CAST(PurchaseCompletionRate AS DECIMAL(28,12))) AS DOUBLE) / count(*) DESC, ChannelName LIMIT 1) AS best_channel,
    (SELECT {ratio('CAST(sum(CAST(DiscountPercent AS DECIMAL(18,2))) AS DOUBLE)', 'count(*)')} FROM @Performance
     WHERE PurchaseCompletionRate >= (SELECT quantile_cont(PurchaseCompletionRate, 0.5) FROM @Performance)) AS avg_discount_on_winners
    FROM @Performance WHERE PurchaseCompletionRate IS NOT NULL ORDER BY PurchaseCompletionRate DESC, CampaignID LIMIT 1"""


@query("overall_metrics", _OVERALL)
def _(t, env):
    return R.overall_metrics(t)


@query("latest_model_metrics", _LATEST_MODEL)
def _(t, env):
    return R.latest_model_metrics(t)


@query("best_campaign_and_channel", _BEST)
def _(t, env):
    return R.best_campaign_and_channel(t)


@query("top_campaign_of_key", "SELECT * FROM @Performance WHERE CampaignID = 7")
def _(t, env):
    return R.top_campaign(t, campaign_id=7)


@query("top_campaign", "SELECT * FROM @Performance ORDER BY TotalRevenueGenerated DESC, CampaignID LIMIT 1")
def _(t, env):
    return R.top_campaign(t)


_CLOSING = "Answer in five headed sections, in this order: Executive Summary, Key Findings, Business Insights, Marketing Recommendations, Conclusion. " \
    "Use only the figures above. Name no period of time that is not given above. Write in a professional tone, in fewer than 400 words."


def _prompt(intro, *lines):
    parts = [f"'{intro}'"] + [f"'- {label}: ' || coalesce({value}, 'n/a')" for label, value in lines] + [f"'{_CLOSING}'"]
    return " || chr(10) || ".join(parts)


def _str(x):
    return f"CAST({x} AS VARCHAR)"


_CAMPAIGN_PROMPT = "SELECT CampaignID, " + _prompt(
    "Explain the performance of this retail marketing campaign.",
    ("Campaign", "CampaignName || ' via ' || ChannelName"),
    ("Discount offered", "CAST(CAST(DiscountPercent AS DECIMAL(5,2)) AS VARCHAR) || '%'"),
    ("Customers contacted", _str("CustomersContacted")), ("Open rate", percent_text("OpenRate")),
    ("Completed purchases", percent_text("PurchaseCompletionRate")), ("Revenue", dollars_text("TotalRevenueGenerated")),
    ("Average purchase", dollars_text("AveragePurchaseAmount")),
) + " AS Prompt FROM @Performance"

_PROGRAM = [("Total customers", _str("total_customers")), ("Campaign response rate", percent_text("response_rate")),
            ("Prediction accuracy", percent_text("model_accuracy")), ("Total revenue", dollars_text("total_revenue"))]


@query("prompts_batch", f"""SELECT 'Campaign Analysis' AS ReportType, CAST(CampaignID AS DOUBLE) AS CampaignID, Prompt FROM ({_CAMPAIGN_PROMPT}) a
    UNION ALL SELECT 'Executive Summary', NULL, {_prompt('Summarise the state of this retail campaign program.', *_PROGRAM, ('Active customers', _str('active_customers')), ('Campaigns', _str('total_campaigns')))} FROM ({_OVERALL}) o
    UNION ALL SELECT 'Dashboard Commentary', NULL, {_prompt('Write a comment of under 150 words for a store manager who looks at a dashboard with these figures.', *_PROGRAM)} FROM ({_OVERALL}) o
    UNION ALL SELECT 'Prediction Interpretation', NULL, {_prompt('Explain in plain words what this model can and cannot do for the next campaign.', ('Model', 'algorithm'),
        ('Accuracy', percent_text('accuracy * 100.0')), ('Precision', percent_text('precision * 100.0')), ('Recall', percent_text('recall * 100.0')),
        ('F1', percent_text('f1_score * 100.0')), ('Predicted responders', f"{_str('predicted_positive_count')} || ' of ' || {_str('total_scored')}"))} FROM ({_LATEST_MODEL}) m
    UNION ALL SELECT 'Business Recommendations', NULL, {_prompt('Recommend targeting, channel and discount for the coming campaigns.', ('Best channel', 'best_channel'),
        ('Best campaign', 'best_campaign'), ('Its response rate', percent_text('best_campaign_response_rate')), ('Predicted responders', _str('predicted_positive_count')),
        ('Mean discount of successful campaigns', percent_text('avg_discount_on_winners')))} FROM ({_BEST}) b, ({_LATEST_MODEL}) m""")
def _(t, env):
    return optional_numbers(R.prompts_batch(t), "CampaignID")


def _spot(section):
    return f"strpos(ReportText, '{section}')"


_SPOTS = [_spot(s) for s in ("Executive Summary", "Key Findings", "Business Insights", "Marketing Recommendations", "Conclusion")]
_PRESENT = " AND ".join(f"{s} > 0" for s in _SPOTS)
_ORDERED = f"{_SPOTS[0]} > 0 AND " + " AND ".join(f"{b} > {a}" for a, b in zip(_SPOTS, _SPOTS[1:]))


@query("report_sections_check", f"""SELECT AIReportID, length(trim(ReportText, ' ')) > 0 AS HasText, {_PRESENT} AS HasSections, {_ORDERED} AS InOrder FROM
    (SELECT AIReportID, ReportText FROM @AIReport UNION ALL
     SELECT -1 - CampaignID, Prompt FROM ({_CAMPAIGN_PROMPT}) p) x""")
def _(t, env):
    # stored texts and the prompts, which name the sections in order
    prompts = R.campaign_prompts(V.campaign_performance(t)).select((F.lit(-1) - c("CampaignID")).alias("AIReportID"), c("Prompt").alias("ReportText"))
    return R.sections_check(t["AIReport"].select("AIReportID", "ReportText").unionByName(prompts))


# by value: 12.5 is 12.50
_NUMBERS = r"list_distinct(list_filter(list_transform(regexp_extract_all({}, '\d[\d,]*(?:\.\d+)?'), lambda n: TRY_CAST(replace(n, ',', '') AS DECIMAL(38,6))), lambda n: n IS NOT NULL))"
_SHOWN = r"regexp_replace(regexp_replace(CAST(n AS VARCHAR), '0+$', ''), '\.$', '')"


@query("report_number_check", f"""SELECT AIReportID, CAST(len(said) AS BIGINT) AS NumbersFound,
    array_to_string(list_sort(list_transform(list_filter(said, lambda n: NOT list_contains(given, n)), lambda n: {_SHOWN})), '|') AS UnsupportedNumbers FROM (
    SELECT r.AIReportID, {_NUMBERS.format('r.ReportText')} AS said, coalesce({_NUMBERS.format('p.Prompt')}, CAST([] AS DECIMAL(38,6)[])) AS given
    FROM @AIReport r LEFT JOIN ({_CAMPAIGN_PROMPT}) p ON p.CampaignID = r.CampaignID) x""")
def _(t, env):
    return R.number_check(t["AIReport"], R.campaign_prompts(V.campaign_performance(t)), "CampaignID")


# -- generated data --------------------------------------------------------------------------

_GENERATED = {"Stores": "nation", "Products": "part", "Customers": "customer", "LoyaltyMemberships": "customer", "Employees": "supplier",
              "MarketingCampaigns": "part", "SalesTransactions": "orders", "SalesTransactionItems": "lineitem", "CampaignResponses": "events"}


@query("gen_dataset", " UNION ALL ".join(
    f"SELECT '{name}' AS FileName, count(*) AS RecordCount, CAST(0 AS BIGINT) AS BrokenRows FROM {source}" for name, source in _GENERATED.items())
    + f" UNION ALL SELECT 'ProductCategories', CAST({len(generate.CATEGORIES)} AS BIGINT), CAST(0 AS BIGINT)")
def _(t, env):
    # one generated row per row of the given tables
    def ids(name, key):
        return bindings.raw_table(env.spark, env.folder, name).select(key.alias("id"))

    spaces = {
        "Store": ids("nation", c("n_nationkey").cast("long") + 1), "Product": ids("part", c("p_partkey") + 1),
        "Customer": ids("customer", c("c_custkey") + 1), "Employee": ids("supplier", c("s_suppkey") + 1),
        "MarketingCampaign": ids("part", c("p_partkey") + 1), "SalesTransaction": ids("orders", c("o_orderkey") + 1),
        "SalesTransactionItem": ids("lineitem", c("l_orderkey") * 10 + c("l_linenumber")), "CampaignResponse": ids("events", c("event_id") + 1),
    }
    frames = generate.gen_dataset(env.spark, today="2024-12-31", ids=spaces)
    broken = {
        "Customers": ~c("Age").between(18, 85) | (c("RegistrationDate") > "2024-12-31"),
        "LoyaltyMemberships": (c("CurrentPoints") < 0) | (c("LifetimePointsRedeemed") > c("LifetimePointsEarned")),
        "Products": (c("UnitPrice") < c("UnitCost")),
        "ProductCategories": c("CategoryID").isNull() | c("CategoryName").isNull(),
        "MarketingCampaigns": (c("EndDate") < c("StartDate")) | ~c("DiscountPercent").between(0, 50),
        "SalesTransactions": ~F.hour("TransactionDate").between(8, 21) | (c("TransactionTotal") < 0),
        "SalesTransactionItems": F.abs(c("Quantity") * c("UnitPrice") - c("Discount") - c("LineTotal")) > 0.005,
        "CampaignResponses": ((c("CouponUsed") == 1) & (c("EmailOpened") == 0)) | ((c("PurchaseCompleted") == 1) != (c("PurchaseAmount") > 0)),
    }
    results = [
        frames[name].agg(F.count("*").alias("RecordCount"), F.count_if(broken.get(name, F.lit(False))).alias("BrokenRows")).select(
            F.lit(name).alias("FileName"), "RecordCount", "BrokenRows"
        ) for name in [*_GENERATED, "ProductCategories"]
    ]
    total = results[0]
    for more in results[1:]:
        total = total.unionByName(more)
    return total
