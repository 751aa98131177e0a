import pytest

from cartwheel.plans import reports as R
from cartwheel.plans import views as V


def test_overall(tiny, spark):
    row = R.overall_metrics(tiny).first()
    assert tuple(row) == (4, 3, 4, 40.0, 80.0, 22.01)
    untrained = {**tiny, "ModelExecution": tiny["ModelExecution"].where("false")}
    assert R.overall_metrics(untrained).first().model_accuracy == 0.0


def test_latest_model(tiny):
    row = R.latest_model_metrics(tiny).first()
    assert (row.accuracy, row.total_scored, row.predicted_positive_count) == (0.8, 4, 3)
    with pytest.raises(Exception, match="train a model"):
        R.latest_model_metrics({**tiny, "ModelExecution": tiny["ModelExecution"].where("false")}).collect()


def test_best_campaign_and_channel(tiny):
    row = R.best_campaign_and_channel(tiny).first()
    # channel 2 has the mean rate 50, channel 1 has 25; median rate is 50
    assert tuple(row) == ("Big", 50.0, "SMS", 15.0)
    with pytest.raises(Exception, match="load the data"):
        R.best_campaign_and_channel({**tiny, "CampaignResponse": tiny["CampaignResponse"].where("false")}).collect()


def test_top_campaign(tiny):
    assert R.top_campaign(tiny).first().CampaignID == 2
    assert R.top_campaign(tiny, campaign_id=3).first().CampaignName == "Unsent"
    with pytest.raises(Exception, match="no campaign found"):
        R.top_campaign(tiny, campaign_id=99).collect()


def test_prompts(tiny):
    got = R.prompts_batch(tiny).collect()
    kinds = [r.ReportType for r in got]
    assert kinds.count("Campaign Analysis") == 4 and len(got) == 8 and len(set(kinds)) == 5
    assert all(r.Prompt and all(s in r.Prompt for s in R.SECTIONS) for r in got)
    unsent = [r.Prompt for r in got if r.CampaignID == 3][0]
    assert "Open rate: n/a" in unsent and "Revenue: $0.00" in unsent
    summary = [r.Prompt for r in got if r.ReportType == "Executive Summary"][0]
    assert "Total revenue: $22.01" in summary and "Campaign response rate: 40.0%" in summary


def test_sections(spark):
    good = "\n".join(R.SECTIONS)
    texts = [(1, good), (2, "\n".join(reversed(R.SECTIONS))), (3, "   "), (4, None), (5, "Executive Summary only")]
    df = spark.createDataFrame(texts, "AIReportID long, ReportText string")
    got = {r.AIReportID: (r.HasText, r.HasSections, r.InOrder) for r in R.sections_check(df).collect()}
    assert got == {1: (True, True, True), 2: (True, True, False), 3: (False, False, False), 4: (False, False, False), 5: (True, False, False)}


def test_numbers(tiny):
    got = {r.AIReportID: (r.NumbersFound, r.UnsupportedNumbers) for r in
           R.number_check(tiny["AIReport"], R.campaign_prompts(V.campaign_performance(tiny)), "CampaignID").collect()}
    # the prompt of campaign 1 holds a 2 (customers contacted), no 99
    assert got == {1: (2, ["1000.5", "7"]), 2: (2, ["99"]), 3: (0, [])}


def test_numbers_are_compared_by_value(spark):
    reports = spark.createDataFrame([(1, 5, "12.5 of 3.0 and 1,200, 100 but not 12.05, 10"), (2, None, "0.50"), (3, 6, None), (4, 5, "9" * 60)],
                                    "AIReportID long, CampaignID long, ReportText string")
    inputs = spark.createDataFrame([(5, "12.50, 3, 1200.00, 100")], "CampaignID long, Prompt string")
    got = {r.AIReportID: (r.NumbersFound, r.UnsupportedNumbers) for r in R.number_check(reports, inputs, "CampaignID").collect()}
    assert got[1] == (6, ["10", "12.05"]) and got[2] == (1, ["0.5"]) and got[4] == (0, [])
