from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwheel.operators import dimensions as Dim
from cartwheel.operators import quality as Q
from cartwheel.operators import sinks
from cartwheel.plans import load
from cartwheel.session import scratch_path
from cartwheel.sources import files, generate, schemas as S


@pytest.fixture(scope="module")
def loaded(spark):
    """Generated source files with every total set to 0, loaded twice."""
    source, target = scratch_path(spark, "src"), scratch_path(spark, "out")
    frames = generate.gen_dataset(spark, scale=0.02, today="2025-06-30")
    frames["SalesTransactions"] = frames["SalesTransactions"].withColumn("TransactionTotal", F.lit(0.0))
    generate.write_sources(frames, source)
    for _ in range(2):
        counts = load.load_full_refresh(spark, source, target, as_of="2025-06-30")
    return {
        n: files.scan_table(spark, target, n) for n in S.LOADED_TABLES + list(S.SEEDS)
    }, {r.TableName: r.RecordCount for r in counts.collect()}


def test_counts_do_not_double(loaded):
    _tables, counts = loaded
    assert counts["Customer"] == 100 and counts["SalesTransaction"] == 1500 and counts["SalesTransactionItem"] == 5000
    assert counts["CampaignResponse"] == 360 and counts["LoyaltyMembership"] == 100


def test_totals_are_the_sum_of_the_lines(loaded):
    tables, _ = loaded
    lines = tables["SalesTransactionItem"].groupBy("TransactionID").agg(F.sum("LineTotal").alias("t"))
    joined = tables["SalesTransaction"].join(lines, "TransactionID", "left")
    assert joined.where("TransactionTotal <> coalesce(t, 0)").count() == 0
    assert tables["SalesTransaction"].where("TransactionTotal > 0").count() > 1400


def test_unseen_names_enter_the_lookups_and_resolve(loaded):
    tables, counts = loaded
    names = {r.ChannelName: r.MarketingChannelID for r in tables["MarketingChannel"].collect()}
    used = tables["MarketingCampaign"].count()
    assert names["Email"] == 1 and names["Mobile App"] == 3 and used == counts["MarketingCampaign"] == 1
    methods = {r.MethodName: r.PaymentMethodID for r in tables["PaymentMethod"].collect()}
    assert {generate.UNSEEDED_PAYMENT, "Cash", "Debit"} <= set(methods)
    assert sorted(methods.values()) == list(range(1, len(methods) + 1))


def test_loaded_data_is_sound(loaded):
    tables, _ = loaded
    keys = [k for k in S.FOREIGN_KEYS if k[0] in tables and k[2] in tables]
    assert {r.OrphanCount for r in Q.orphans(tables, keys).collect()} == {0}
    rules = [r for r in S.check_rules() if r[0] in tables]
    broken = {(r.TableName, r.RuleName): r.Violations for r in Q.broken_rules(tables, rules).collect()}
    assert set(broken.values()) == {0}
    assert Q.line_arithmetic(tables["SalesTransactionItem"]).count() == 0


def test_malformed_row_fails_the_read(spark, tmp_path):
    (tmp_path / "Stores.csv").write_text('StoreID,StoreName,City,Province\n1,"A, ""B""",C,D\n')
    assert files.scan_source(spark, str(tmp_path), "Stores").first().StoreName == 'A, "B"'
    (tmp_path / "ProductCategories.csv").write_text("CategoryID,CategoryName\nx,Dairy\n")
    with pytest.raises(Exception):
        files.scan_source(spark, str(tmp_path), "ProductCategories").collect()


def test_missing_text_is_null(spark, tmp_path):
    (tmp_path / "Stores.csv").write_text('StoreID,StoreName,City,Province\n1, x ,,NULL\n2,n/a,"",North\n')
    got = files.scan_csv_project(spark, str(tmp_path), "Stores", ["Province", "City", "StoreName"]).collect()
    assert [tuple(r) for r in got] == [(None, None, " x "), ("North", None, None)]


def test_lookup_spelling(spark):
    dim = files.seed_table(spark, "MarketingChannel")
    stage = spark.createDataFrame([("email",), ("Email",), ("Push",), ("PUSH",), ("Push ",), (None,)], "Channel string")
    exact = Dim.upsert_missing(stage, "Channel", dim, "ChannelName", "MarketingChannelID")
    assert exact.count() == 9
    loose = Dim.upsert_missing(stage, "Channel", dim, "ChannelName", "MarketingChannelID", case_insensitive=True)
    assert loose.count() == 6
    resolved = Dim.resolve_key(stage, "Channel", loose, "ChannelName", "MarketingChannelID", case_insensitive=True)
    assert sorted(r.MarketingChannelID for r in resolved.collect()) == [1, 1, 6, 6, 6]
    # nothing new: ids stay as they are
    again = Dim.upsert_missing(stage, "Channel", exact, "ChannelName", "MarketingChannelID")
    assert rows(again, "ChannelName") == rows(exact, "ChannelName")


def test_transaction_without_lines_gets_zero(tiny):
    got = rows(load.recompute_totals(tiny["SalesTransaction"], tiny["SalesTransactionItem"]), "TransactionID")
    assert got[13]["TransactionTotal"] == 0 and got[10]["TransactionTotal"] == Decimal("6.50")


def test_appends(spark, tiny):
    scores = spark.createDataFrame([(1, 0.5, "Yes"), (3, 0.12345, "No")], "CustomerID long, Probability double, Result string")
    new = sinks.prediction_rows(scores, tiny["CustomerPrediction"], ml_model="RF", model_version="v1", as_of="2024-02-01")
    assert sorted(r.PredictionID for r in new.collect()) == [5, 6]
    assert {r.PredictionDate for r in new.collect()} == {new.first().PredictionDate}
    reports = spark.createDataFrame([("Campaign Analysis", 1, "text")], "ReportType string, CampaignID long, ReportText string")
    row = sinks.report_rows(reports, tiny["AIReport"], model_name="m", prompt_version="v").first()
    assert (row.AIReportID, row.Approved) == (4, False) and row.GeneratedDate is not None


def test_defaults(spark):
    partial = spark.createDataFrame([(1, None)], "ResponseID long, EmailOpened boolean")
    row = sinks.with_defaults(partial, "CampaignResponse").first()
    assert (row.EmailOpened, row.CouponUsed, row.PurchaseAmount) == (False, False, 0)
    assert sinks.with_defaults(spark.range(1), "Customer").first().CustomerStatus == "Active"


def test_bucketed_tables_join_without_a_shuffle(spark, tiny):
    for name in ("SalesTransaction", "SalesTransactionItem"):
        spark.sql(f"DROP TABLE IF EXISTS default.co_{name}")
        sinks.save_bucketed(tiny[name], f"default.co_{name}", "TransactionID", 4)
    # tiny tables would be broadcast; look at the plan large ones get
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("default.co_SalesTransaction").join(spark.table("default.co_SalesTransactionItem"), "TransactionID")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("SalesTransaction", "SalesTransactionItem"):
            spark.sql(f"DROP TABLE IF EXISTS default.co_{name}")


def test_lookup_ids_survive_another_load(spark):
    target, kept = scratch_path(spark, "ids"), {}
    for names in (["Zeta"], ["Alpha", "Beta", "Zeta", "Gamma"]):
        source = scratch_path(spark, "src")
        frames = generate.gen_dataset(spark, scale=0.1, today="2025-06-30")
        channel = F.element_at(F.array(*map(F.lit, names)), (F.col("CampaignID") % len(names) + 1).cast("int"))
        frames["MarketingCampaigns"] = frames["MarketingCampaigns"].withColumn("Channel", channel)
        generate.write_sources(frames, source)
        load.load_full_refresh(spark, source, target, as_of="2025-06-30")
        ids = {r.ChannelName: r.MarketingChannelID for r in files.scan_table(spark, target, "MarketingChannel").collect()}
        assert kept.items() <= ids.items() and sorted(ids.values()) == list(range(1, len(ids) + 1))
        kept = ids
    assert {"Zeta", "Alpha", "Beta", "Gamma", "Email"} <= set(kept)


def test_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "Stores.csv").write_text("Province,Extra,StoreID,City,StoreName\nNorth,x,1,A,S1\nNA,y,n/a,B,S2\n")
    got = files.scan_csv_project(spark, str(tmp_path), "Stores", ["StoreID", "StoreName", "Province"]).collect()
    assert [tuple(r) for r in got] == [(1, "S1", "North"), (None, "S2", None)]
    with pytest.raises(ValueError, match="no column"):
        files.scan_csv_project(spark, str(tmp_path), "Stores", ["Town"])
    (tmp_path / "Stores.csv").write_text("StoreID,StoreName,City,Province\nseven,S1,A,North\n")
    with pytest.raises(Exception, match="StoreID"):
        files.scan_csv_project(spark, str(tmp_path), "Stores", ["StoreID"]).collect()
    (tmp_path / "Stores.csv").write_text("StoreID,City,StoreName,Province\n1,A,S1,North\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        files.scan_source(spark, str(tmp_path), "Stores").collect()
