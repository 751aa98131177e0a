"""Generated files to stored predictions and reports."""

from cartwheel.operators import quality as Q
from cartwheel.operators import sinks
from cartwheel.plans import dashboards as D
from cartwheel.plans import learning as L
from cartwheel.plans import load
from cartwheel.plans import reports as R
from cartwheel.plans import views as V
from cartwheel.session import scratch_path
from cartwheel.sources import files, generate, schemas as S

AS_OF = "2025-06-30 12:00:00"


def test_load_train_score_report(spark):
    source, folder = scratch_path(spark, "e2e-src"), scratch_path(spark, "e2e")
    generate.write_sources(generate.gen_dataset(spark, scale=0.1, today="2025-06-30"), source)
    load.load_full_refresh(spark, source, folder, as_of=AS_OF)
    fresh = files.scan_store(spark, folder)
    assert fresh["ModelExecution"].count() == 0 and fresh["CustomerPrediction"].count() == 0

    for run in (1, 2):
        metrics = L.train_and_store(spark, folder, as_of=f"2025-07-0{run} 00:00:00", numTrees=20).first()
    # the response rate holds the label, so the model finds much of it
    assert metrics.accuracy > 0.7

    tables = files.scan_store(spark, folder)
    assert tables["CustomerPrediction"].count() == 1000
    assert L.model_log(spark, folder).count() == 2
    assert sorted(r.PredictionID for r in tables["CustomerPrediction"].collect()) == list(range(1, 1001))
    assert [r.ExecutionID for r in V.model_history(tables).collect()] == [2, 1]
    assert {r.OrphanCount for r in Q.orphans(tables, S.FOREIGN_KEYS).collect()} == {0}
    assert {r.Violations for r in Q.broken_rules(tables, S.check_rules()).collect()} == {0}
    known = sum(r.RecordCount for r in D.confusion_matrix(tables).collect())
    assert known == V.customer_analytics(tables, as_of=AS_OF).where("PurchaseCompleted is not null").count()
    assert R.latest_model_metrics(tables).first().total_scored == 1000

    prompts = R.prompts_batch(tables).selectExpr("ReportType", "CampaignID", "Prompt AS ReportText")
    rows = sinks.report_rows(prompts, tables["AIReport"], model_name="m", prompt_version=R.PROMPT_VERSION, as_of=AS_OF)
    sinks.write_table(rows, folder, "AIReport", "append")
    stored = files.scan_store(spark, folder)["AIReport"]
    assert stored.count() == 4 + 4 and stored.where("Approved").count() == 0
    sinks.approve_report(spark, folder, 3, as_of=AS_OF)
    assert [r.AIReportID for r in files.scan_store(spark, folder)["AIReport"].where("Approved").collect()] == [3]

    # a stored model scores again, in a run of its own
    assert L.score_and_store(spark, folder, as_of=AS_OF).first().Scored == 500
    assert files.scan_table(spark, folder, "CustomerPrediction").count() == 1500

    # a new load clears predictions and reports, not the log of runs
    load.load_full_refresh(spark, source, folder, as_of=AS_OF)
    again = files.scan_store(spark, folder)
    assert [again[n].count() for n in ("CustomerPrediction", "AIReport", "ModelExecution")] == [0, 0, 2]
