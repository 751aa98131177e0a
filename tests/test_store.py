"""Versions of a store: all tables or none, counts from the writes."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwheel.operators import quality as Q
from cartwheel.operators import sinks, store
from cartwheel.plans import load
from cartwheel.session import scratch_path
from cartwheel.sources import files, generate, schemas as S

AS_OF = "2025-06-30"


def sources(spark, seed=42, **changed):
    folder = scratch_path(spark, "src")
    frames = generate.gen_dataset(spark, scale=0.01, seed=seed, today=AS_OF)
    generate.write_sources(frames | {n: change(frames[n]) for n, change in changed.items()}, folder)
    return folder


def content(spark, folder):
    return {n: sorted(map(str, df.collect())) for n, df in files.scan_store(spark, folder).items()}


def test_a_load_that_breaks_leaves_the_old_tables(spark, monkeypatch):
    target = scratch_path(spark, "store")
    load.load_full_refresh(spark, sources(spark), target, as_of=AS_OF)
    before = content(spark, target)
    # a text where a number belongs, in the last table to be written
    bad = sources(spark, 43, CampaignResponses=lambda df: df.withColumn("PurchaseAmount", F.lit("much")))
    with pytest.raises(Exception, match="PurchaseAmount|much|[Mm]alformed"):
        load.load_full_refresh(spark, bad, target, as_of=AS_OF)
    assert content(spark, target) == before

    # everything written, nothing published
    with monkeypatch.context() as m:
        def broken(*a, **k):
            raise RuntimeError("lost")
        m.setattr(store, "publish", broken)
        with pytest.raises(RuntimeError):
            load.load_full_refresh(spark, sources(spark, 43), target, as_of=AS_OF)
    assert content(spark, target) == before

    load.load_full_refresh(spark, sources(spark, 43), target, as_of=AS_OF)
    assert content(spark, target)["Customer"] != before["Customer"]
    assert {r.Version for r in store.version_log(spark, target).collect()} == {1, 2}
    old = store.at_version(spark, target, 1)
    assert {n: sorted(map(str, df.collect())) for n, df in old.items() if n in S.LOADED_TABLES} == {n: before[n] for n in S.LOADED_TABLES}
    assert len(store.expire(spark, target, keep=1)) == 1
    assert files.scan_table(spark, target, "Customer").count() == 50
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.at_version(spark, target, 1)["Customer"].count()


def test_counts_of_the_writes_are_those_of_a_scan(spark):
    target = scratch_path(spark, "store")
    odd = sources(spark, CampaignResponses=lambda df: df.withColumn("PurchaseAmount", F.when(F.col("ResponseID") <= 3, -1.0).otherwise(F.col("PurchaseAmount"))),
                  Products=lambda df: df.withColumn("UnitCost", F.when(F.col("ProductID") == 1, -2.0).otherwise(F.col("UnitCost"))))
    counts = load.load_full_refresh(spark, odd, target, as_of=AS_OF)
    tables = files.scan_store(spark, target)
    assert rows(counts, "TableName") == rows(Q.row_counts(tables, S.LOADED_TABLES), "TableName")
    rules = [r for r in S.check_rules() if r[0] in S.LOADED_TABLES]
    seen = {(r.TableName, r.RuleName): r.Violations for r in store.violations(spark, target).collect()}
    assert seen == {(r.TableName, r.RuleName): r.Violations for r in Q.broken_rules(tables, rules).collect()}
    assert seen["CampaignResponse", "amount_not_negative"] == 3 and seen["Product", "cost_not_negative"] == 1


def test_empty_sources(spark, tmp_path):
    for name, schema in S.CSV_FILES.items():
        (tmp_path / f"{name}.csv").write_text(",".join(c.split()[0] for c in schema.split(", ")) + "\n")
    target = scratch_path(spark, "store")
    counts = load.load_full_refresh(spark, str(tmp_path), target, as_of=AS_OF)
    assert {r.TableName: r.RecordCount for r in counts.collect()} == dict.fromkeys(S.LOADED_TABLES, 0)
    assert files.scan_table(spark, target, "LoyaltyLevel").count() == 4


def test_rejected_lines(spark, tmp_path):
    for name, schema in S.CSV_FILES.items():
        (tmp_path / f"{name}.csv").write_text(",".join(c.split()[0] for c in schema.split(", ")) + "\n")
    with open(tmp_path / "Stores.csv", "a") as f:
        f.write('1,"A, ""B""",C,D\nseven,S,C,D\n2,S2,C\n3,S3,C,D\n')
    with open(tmp_path / "MarketingCampaigns.csv", "a") as f:
        f.write("1,Good,Email,2024-01-01,2024-01-09,10.00\n2,Bad,Carrier pigeon,2024-01-01,soon,lots\n")
    target = scratch_path(spark, "store")
    with pytest.raises(load.TooManyRejects, match="3 lines"):
        load.load_full_refresh(spark, str(tmp_path), target, as_of=AS_OF, max_rejects=2)
    assert store.published(spark, target) == {}
    with pytest.raises(Exception):
        load.load_full_refresh(spark, str(tmp_path), target, as_of=AS_OF)
    load.load_full_refresh(spark, str(tmp_path), target, as_of=AS_OF, max_rejects=3)
    lines = {r.Line: (r.FileName, r.Reason) for r in files.scan_table(spark, target, load.REJECTS).collect()}
    assert lines == {
        "seven,S,C,D": ("Stores", "not of its type: StoreID"), "2,S2,C": ("Stores", "not a line of 4 columns"),
        "2,Bad,Carrier pigeon,2024-01-01,soon,lots": ("MarketingCampaigns", "not of its type: EndDate, DiscountPercent")}
    assert {r.StoreID: r.StoreName for r in files.scan_table(spark, target, "Store").collect()} == {1: 'A, "B"', 3: "S3"}
    # a name that only a rejected line holds is not a lookup name
    assert files.scan_table(spark, target, "MarketingChannel").where("ChannelName like 'Carrier%'").count() == 0


def test_appends_go_to_the_newest_version(spark):
    target, source = scratch_path(spark, "store"), sources(spark)
    load.load_full_refresh(spark, source, target, as_of=AS_OF)
    scores = spark.createDataFrame([(1, 0.5, "Yes")], "CustomerID long, Probability double, Result string")
    for n in (1, 2):
        stored = files.scan_table(spark, target, "CustomerPrediction")
        row = sinks.prediction_rows(scores, stored, ml_model="m", model_version="v", as_of=AS_OF)
        sinks.write_table(row, target, "CustomerPrediction", "append")
        assert files.scan_table(spark, target, "CustomerPrediction").count() == n
    load.load_full_refresh(spark, source, target, as_of=AS_OF)
    assert files.scan_table(spark, target, "CustomerPrediction").count() == 0


def test_decisions_do_not_rewrite_reports(spark, tiny):
    folder = scratch_path(spark, "reports")
    sinks.write_table(tiny["AIReport"], folder, "AIReport")
    files_before = sorted(spark.read.parquet(f"{folder}/AIReport").inputFiles())

    def approved():
        return {r.AIReportID: r.Approved for r in files.scan_table(spark, folder, "AIReport").collect()}

    assert approved() == {1: False, 2: False, 3: True}
    sinks.approve_report(spark, folder, 2, as_of=AS_OF)
    sinks.approve_report(spark, folder, 3, approve=False, as_of=AS_OF)
    assert approved() == {1: False, 2: True, 3: False}
    sinks.approve_report(spark, folder, 2, approve=False, as_of=AS_OF)
    sinks.approve_report(spark, folder, 2, as_of=AS_OF)
    sinks.approve_report(spark, folder, 77, as_of=AS_OF)
    assert approved() == {1: False, 2: True, 3: False}
    assert sorted(spark.read.parquet(f"{folder}/AIReport").inputFiles()) == files_before
    assert [r.DecisionID for r in files.stored_decisions(spark, folder).orderBy("DecisionID").collect()] == [1, 2, 3, 4, 5]


def test_a_load_with_rejects_parses_each_file_once(spark, monkeypatch):
    source, target, read = sources(spark), scratch_path(spark, "store"), []
    parse = files.scan_csv_checked
    monkeypatch.setattr(files, "scan_csv_checked", lambda s, path, schema: read.append(path) or parse(s, path, schema))
    staged = load.stage_sources(spark, source)
    assert not any(path.endswith(".csv") for rows in staged.values() for path in rows.inputFiles())
    read.clear()
    counts = load.load_full_refresh(spark, source, target, as_of=AS_OF, max_rejects=3)
    assert len(read) == len(set(read)) == len(S.CSV_FILES)
    plain = load.load_full_refresh(spark, source, scratch_path(spark, "store"), as_of=AS_OF)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, plain.collect()))
