"""Response prediction: features, split, forest, evaluation, scoring."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators import sinks, store
from cartwheel.operators.ordering import hash_positions
from cartwheel.plans.views import customer_analytics
from cartwheel.session import materialize
from cartwheel.sources import files

# The ten features in model order.
FEATURES = [
    "Age", "LoyaltyLevelEncoded", "NumTransactions", "TotalAmountSpent", "AveragePurchaseValue",
    "DaysSinceLastPurchase", "NumCampaignsReceived", "CampaignResponseRate", "NumDistinctProductsPurchased",
    "AverageDiscountReceived",
]
ZERO_FILLED = [
    "NumTransactions", "TotalAmountSpent", "AveragePurchaseValue", "NumCampaignsReceived", "CampaignResponseRate",
    "NumDistinctProductsPurchased", "AverageDiscountReceived",
]
NO_RECENCY = 9999
# The model's settings.
ALGORITHM, MODEL_VERSION = "RandomForest", "v1.0"
TEST_SHARE, SEED = 0.2, 42
FOREST = dict(numTrees=200, maxDepth=10, minInstancesPerNode=5, seed=SEED)


def impute_recency(analytics: DataFrame) -> DataFrame:
    """A customer who never bought gets a recency one day worse than the worst
    observed one, or 9999 when none is observed."""
    worst = analytics.agg(F.max("DaysSinceLastPurchase") + 1).scalar()
    filled = F.coalesce(F.col("DaysSinceLastPurchase"), worst, F.lit(NO_RECENCY))
    return analytics.withColumn("DaysSinceLastPurchase", filled)


def impute_zero(analytics: DataFrame) -> DataFrame:
    return analytics.fillna(0, subset=ZERO_FILLED)


def drop_unlabelled(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["PurchaseCompleted"])


def features(analytics: DataFrame, for_training: bool = True) -> DataFrame:
    """CustomerID, the ten features and, for training, the 0/1 label."""
    work = impute_zero(impute_recency(analytics)).withColumn(
        "LoyaltyLevelEncoded", E.loyalty_ordinal(F.col("LoyaltyLevel"))
    )
    if not for_training:
        return work.select("CustomerID", *FEATURES)
    return drop_unlabelled(work).select("CustomerID", *FEATURES, F.col("PurchaseCompleted").cast("int").alias("label"))


def label_balance(analytics: DataFrame) -> DataFrame:
    """Labelled rows, positive share and the rows without a label."""
    labelled = F.count("PurchaseCompleted")
    positive = F.count_if("PurchaseCompleted")
    return analytics.agg(
        labelled.alias("LabelledRows"),
        F.count_if(F.col("PurchaseCompleted").isNull()).alias("DroppedRows"),
        E.ratio(positive, labelled).alias("PositiveRate"),
    )


def stratified_split(labelled: DataFrame, *, key: str = "CustomerID", label: str = "label",
                     test_share: float = TEST_SHARE, seed: int = SEED, approx: bool = False) -> DataFrame:
    """Adds ``is_test``: a share of each class, chosen by the md5 of key and
    seed, so the same rows are test rows in every run.

    Exact by default: the first round(share * n) rows of each class in hash
    order.  ``approx`` compares the hash with the share instead and needs no
    shuffle.
    """
    hashed = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    if approx:
        spot = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
        return labelled.withColumn("is_test", spot < F.lit(test_share))
    placed = hash_positions(labelled, hashed, "_position", [label], size="_size")
    test_rows = F.floor(F.col("_size") * F.lit(test_share) + F.lit(0.5))
    return placed.withColumn("is_test", F.col("_position") <= test_rows).select(*labelled.columns, "is_test")


def class_weights(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = labelled.groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes")).alias("w")).scalar()
    return counts.select(label, "n", E.ratio(whole["rows"], whole["classes"] * F.col("n")).alias("weight"))


def with_class_weight(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``weight`` without a join: the few class weights form one map."""
    pairs = F.map_from_entries(F.collect_list(F.struct(label, "weight")))
    weights = class_weights(labelled, label).agg(pairs.alias("m")).scalar()
    return labelled.withColumn("weight", F.element_at(weights, F.col(label)))


MODELS = "_models"  # a store's folder of models and, beside them, the log of those whole
MODEL_LOG = "ModelID string, Path string, Threshold double, Seconds double, TrainRows bigint, SavedAt timestamp_ntz"


@dataclass(frozen=True)
class ResponseModel:
    """A stored model: the pipeline from feature columns to a probability and
    the probability from which a customer counts as responding."""

    model_id: str
    pipeline: PipelineModel
    threshold: float
    seconds: float
    train_rows: int

    @property
    def forest(self) -> RandomForestClassificationModel:
        return self.pipeline.stages[-1]


def train_random_forest(train: DataFrame, folder: str, *, max_memory_mb: int = 1024, threshold: float = 0.5, as_of=None,
                        **settings) -> ResponseModel:
    """Fit the forest on labelled features, store it in ``folder`` and return it
    as stored.

    The fit passes over its input several times, so the input is written once
    to the shared folder first.  ``max_memory_mb`` bounds the node statistics
    gathered per pass: more memory means fewer passes over the data.  A model
    counts as stored when its row is in the log, which is written last.
    """
    stored = materialize(with_class_weight(train).select(*FEATURES, "label", "weight"), "train")
    spark = stored.sparkSession
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxMemoryInMB=max_memory_mb,
        **{**FOREST, **settings},
    )
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest])
    started = time.perf_counter()
    model = pipeline.fit(stored)
    seconds = time.perf_counter() - started
    model_id = uuid.uuid4().hex
    model.write().save(f"{folder}/{MODELS}/{model_id}")
    row = stored.agg(F.count("*").alias("TrainRows")).select(
        F.lit(model_id).alias("ModelID"), F.lit(f"{MODELS}/{model_id}").alias("Path"), F.lit(threshold).alias("Threshold"),
        F.lit(seconds).alias("Seconds"), "TrainRows", E.now(as_of).alias("SavedAt"))
    row.coalesce(1).write.mode("append").parquet(f"{folder}/{MODELS}_log")
    return load_model(spark, folder, model_id)


def model_log(spark: SparkSession, folder: str) -> DataFrame:
    """The stored models of a folder."""
    log = store.read_or_none(spark, f"{folder}/{MODELS}_log", MODEL_LOG)
    return spark.createDataFrame([], MODEL_LOG) if log is None else log


def load_model(spark: SparkSession, folder: str, model_id: str | None = None) -> ResponseModel:
    """A stored model by id, else the one saved last."""
    log = model_log(spark, folder)
    row = (log.where(F.col("ModelID") == model_id) if model_id else log).orderBy(F.col("SavedAt").desc(), "ModelID").first()
    if row is None:
        raise LookupError(f"no model {model_id or ''} in {folder}")
    return ResponseModel(row.ModelID, PipelineModel.load(f"{folder}/{row.Path}"), row.Threshold, row.Seconds, row.TrainRows)


def feature_importance(model: ResponseModel, spark: SparkSession) -> DataFrame:
    """Importance per feature, largest first."""
    pairs = [(name, float(v)) for name, v in zip(FEATURES, model.forest.featureImportances.toArray())]
    return spark.createDataFrame(pairs, "Feature string, Importance double").orderBy(F.col("Importance").desc(), "Feature")


def _probability() -> Column:
    return vector_to_array("probability")[1]


def predict(model: ResponseModel, labelled: DataFrame) -> DataFrame:
    """The model's class for rows with a label."""
    return model.pipeline.transform(labelled).select(
        "CustomerID", "label", (_probability() >= F.lit(model.threshold)).cast("int").alias("prediction")
    )


def evaluate_classifier(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: confusion counts, accuracy, precision, recall, F1; a metric
    without a denominator is 0."""
    def cell(actual, said):
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == said))

    counts = predicted.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        "tn", "fp", "fn", "tp",
        E.zero_f(E.ratio(tp + tn, tp + tn + fp + fn)).alias("accuracy"),
        E.zero_f(E.ratio(tp, tp + fp)).alias("precision"),
        E.zero_f(E.ratio(tp, tp + fn)).alias("recall"),
        E.zero_f(E.ratio(tp * 2, tp * 2 + fp + fn)).alias("f1_score"),
    )


def evaluation_text(metrics: DataFrame) -> DataFrame:
    """One readable sentence per metric."""
    pct = {m: E.percent_text(F.col(m) * 100.0) for m in ("accuracy", "precision", "recall")}
    sentences = {
        "accuracy": F.concat(pct["accuracy"], F.lit(" of the customers were classified correctly.")),
        "precision": F.concat(
            pct["precision"],
            F.lit(" of the customers predicted to respond did respond; the rest is spend on customers who do not buy."),
        ),
        "recall": F.concat(
            pct["recall"], F.lit(" of the customers who respond were found; the others are missed opportunities."),
        ),
        "f1_score": F.format_string("The balance of precision and recall (F1) is %.3f.", E.half_up(F.col("f1_score"), 3)),
        "confusion_matrix": F.format_string(
            "%d true negatives, %d false positives, %d false negatives, %d true positives.", "tn", "fp", "fn", "tp"
        ),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("Metric"), v.alias("Sentence")) for k, v in sentences.items()])
    return metrics.select(F.explode(rows).alias("r")).select("r.*")


def score_all(model: ResponseModel, scoring: DataFrame) -> DataFrame:
    """CustomerID, probability of a response and Yes/No for every customer."""
    scored = model.pipeline.transform(scoring)
    return scored.select("CustomerID", _probability().alias("Probability"), E.yes_no(_probability(), model.threshold).alias("Result"))


def score_summary(scores: DataFrame) -> DataFrame:
    positive = F.count_if(F.col("Result") == "Yes")
    return scores.agg(
        F.count("*").alias("Scored"), positive.alias("PredictedYes"),
        E.percent(positive, F.count("*")).alias("PredictedYesPct"),
    )


def train_and_store(spark: SparkSession, folder: str, *, as_of=None, **settings) -> DataFrame:
    """The whole run on a stored load: analytics, features, split, fit, stored
    model, evaluation on the test rows, scores for every customer, and both
    appends.  Returns the metrics row; only that row is ever computed for the
    driver."""
    tables = files.scan_store(spark, folder)
    analytics = materialize(customer_analytics(tables, as_of=as_of), "analytics")
    split = materialize(stratified_split(features(analytics)), "split")
    model = train_random_forest(split.where("not is_test"), folder, as_of=as_of, **settings)
    metrics = materialize(evaluate_classifier(predict(model, split.where("is_test"))), "metrics")
    run = sinks.execution_row(
        metrics, tables["ModelExecution"], algorithm=ALGORITHM, duration_seconds=model.seconds, as_of=as_of
    )
    _append_scores(model, analytics, tables["CustomerPrediction"], folder, as_of)
    sinks.write_table(run, folder, "ModelExecution", "append")
    return metrics


def score_and_store(spark: SparkSession, folder: str, *, model_id: str | None = None, as_of=None) -> DataFrame:
    """A run of its own, in any later session: loads a stored model (the newest
    by default), scores every customer as of now and appends the predictions.
    Returns the summary of the new scores."""
    model = load_model(spark, folder, model_id)
    tables = files.scan_store(spark, folder)
    return score_summary(_append_scores(model, customer_analytics(tables, as_of=as_of), tables["CustomerPrediction"], folder, as_of))


def _append_scores(model: ResponseModel, analytics: DataFrame, existing: DataFrame, folder: str, as_of) -> DataFrame:
    scores = materialize(score_all(model, features(analytics, for_training=False)), "scores")
    rows = sinks.prediction_rows(scores, existing, ml_model=ALGORITHM, model_version=MODEL_VERSION, as_of=as_of)
    sinks.write_table(rows, folder, "CustomerPrediction", "append")
    return scores
