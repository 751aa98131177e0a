import os
import subprocess
import sys

import pytest
from conftest import AS_OF, rows
from pyspark.sql import functions as F

from cartwheel.plans import learning as L
from cartwheel.plans import views as V
from cartwheel.session import scratch_path


def test_features(tiny):
    base = V.customer_analytics(tiny, as_of=AS_OF)
    scoring = rows(L.features(base, for_training=False), "CustomerID")
    # the worst observed recency is 185 days
    assert scoring[3]["DaysSinceLastPurchase"] == 186
    assert [scoring[i]["LoyaltyLevelEncoded"] for i in (1, 2, 3, 4)] == [1, 0, 0, 4]
    training = rows(L.features(base), "CustomerID")
    assert {k: v["label"] for k, v in training.items()} == {1: 0, 2: 1, 4: 0}
    assert L.features(base).columns == ["CustomerID", *L.FEATURES, "label"]
    balance = L.label_balance(base).first()
    assert (balance.LabelledRows, balance.DroppedRows, balance.PositiveRate) == (3, 1, pytest.approx(1 / 3))


def test_no_recency_at_all(tiny):
    base = V.customer_analytics(tiny, as_of=AS_OF).withColumn("DaysSinceLastPurchase", F.lit(None).cast("int"))
    assert {r.DaysSinceLastPurchase for r in L.impute_recency(base).collect()} == {9999}


@pytest.fixture(scope="module")
def labelled(spark):
    """600 rows whose label follows two features."""
    df = spark.range(600).withColumnRenamed("id", "CustomerID")
    for i, name in enumerate(L.FEATURES):
        df = df.withColumn(name, F.pmod(F.xxhash64("CustomerID", F.lit(i)), F.lit(100)).cast("double"))
    return df.withColumn("label", ((F.col("Age") + F.col("CampaignResponseRate")) > 120).cast("int"))


def test_split_is_stratified_and_repeatable(labelled):
    split = L.stratified_split(labelled).collect()
    for label in (0, 1):
        mine = [r for r in split if r.label == label]
        assert abs(sum(r.is_test for r in mine) - 0.2 * len(mine)) <= 0.5
    again = {r.CustomerID: r.is_test for r in L.stratified_split(labelled.repartition(5)).collect()}
    assert again == {r.CustomerID: r.is_test for r in split}
    other = {r.CustomerID: r.is_test for r in L.stratified_split(labelled, seed=7).collect()}
    assert other != again
    share = L.stratified_split(labelled, approx=True).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert 0.14 < share < 0.26


def test_class_weights_balance(labelled):
    got = {r.label: r for r in L.class_weights(labelled).collect()}
    assert got[0].n * got[0].weight == pytest.approx(300) and got[1].n * got[1].weight == pytest.approx(300)
    weighted = L.with_class_weight(labelled).groupBy("label").agg(F.min("weight").alias("lo"), F.max("weight").alias("hi"))
    for r in weighted.collect():
        assert r.lo == r.hi == got[r.label].weight


def test_evaluation(spark):
    def metrics(pairs):
        df = spark.createDataFrame(pairs, "label int, prediction int")
        return L.evaluate_classifier(df).first().asDict()

    got = metrics([(1, 1)] * 336 + [(0, 0)] * 417 + [(0, 1)] * 133 + [(1, 0)] * 87)
    assert [got[c] for c in ("tn", "fp", "fn", "tp")] == [417, 133, 87, 336]
    assert got["accuracy"] == pytest.approx(753 / 973) and got["precision"] == pytest.approx(336 / 469)
    assert got["recall"] == pytest.approx(336 / 423) and got["f1_score"] == pytest.approx(672 / 892)
    none = metrics([(0, 0), (1, 0)])
    assert (none["precision"], none["recall"], none["f1_score"], none["accuracy"]) == (0, 0, 0, 0.5)
    text = {r.Metric: r.Sentence for r in L.evaluation_text(L.evaluate_classifier(
        spark.createDataFrame([(1, 1), (0, 0), (0, 1)], "label int, prediction int"))).collect()}
    assert text["accuracy"].startswith("66.7%") and text["f1_score"].endswith("0.667.")
    assert text["confusion_matrix"].startswith("1 true negatives, 1 false positives")


def test_forest(labelled, spark):
    split, folder = L.stratified_split(labelled), scratch_path(spark, "models")
    model = L.train_random_forest(split.where("not is_test"), folder, numTrees=20, as_of=AS_OF)
    assert model.seconds > 0 and model.forest.getNumTrees == 20 and model.train_rows == split.where("not is_test").count()
    metrics = L.evaluate_classifier(L.predict(model, split.where("is_test"))).first()
    assert metrics.tn + metrics.fp + metrics.fn + metrics.tp == split.where("is_test").count()
    assert metrics.accuracy > 0.8
    best = [r.Feature for r in L.feature_importance(model, spark).collect()]
    assert set(best[:2]) == {"Age", "CampaignResponseRate"} and len(best) == 10
    scores = L.score_all(model, labelled.drop("label"))
    assert scores.where("(Probability >= 0.5) <> (Result = 'Yes')").count() == 0
    summary = L.score_summary(scores).first()
    assert summary.Scored == 600 and summary.PredictedYesPct == pytest.approx(100 * summary.PredictedYes / 600)
    again = L.train_random_forest(split.where("not is_test"), folder, numTrees=20, threshold=0.8, as_of="2024-03-01")
    assert again.forest.featureImportances == model.forest.featureImportances

    # the newest one, by id, and its own threshold
    assert L.load_model(spark, folder).model_id == again.model_id
    loaded = L.load_model(spark, folder, model.model_id)
    assert sorted(map(tuple, L.score_all(loaded, labelled).collect())) == sorted(map(tuple, scores.collect()))
    assert L.score_all(again, labelled).where("(Probability >= 0.8) <> (Result = 'Yes')").count() == 0
    with pytest.raises(LookupError):
        L.load_model(spark, folder, "none")
    with pytest.raises(LookupError):
        L.load_model(spark, scratch_path(spark, "models"))


def test_model_in_another_session(labelled, spark, tmp_path):
    """A process that knows nothing but the folder scores alike."""
    folder, scores, rows_path = scratch_path(spark, "models"), scratch_path(spark, "scores"), scratch_path(spark, "rows")
    model = L.train_random_forest(labelled, folder, numTrees=5, as_of=AS_OF)
    labelled.write.parquet(rows_path)
    code = f"""
from cartwheel.session import build_session
from cartwheel.plans import learning as L
spark = build_session("local[2]", spark__sql__shuffle__partitions="2")
L.score_all(L.load_model(spark, {folder!r}), spark.read.parquet({rows_path!r})).write.parquet({scores!r})
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": root}, check=True, capture_output=True)
    assert sorted(map(tuple, spark.read.parquet(scores).collect())) == sorted(map(tuple, L.score_all(model, labelled).collect()))


def test_training_and_scoring_share_the_stored_analytics(spark, tiny, monkeypatch):
    from registry import model as M

    asked = []
    monkeypatch.setattr(M, "analytics", lambda t: asked.append(1) or V.customer_analytics(t, as_of=AS_OF))
    monkeypatch.setattr(M, "stored_model", lambda t, env, rows=None: rows)
    monkeypatch.setattr(L, "score_all", lambda trained_on, scoring: (trained_on, scoring))
    trained_on, scoring = M.scores(tiny, None)
    assert len(asked) == 1
    assert set(scoring.inputFiles()) == set(trained_on.inputFiles()) and all("/analytics-" in path for path in scoring.inputFiles())
