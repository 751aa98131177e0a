from conftest import AS_OF, rows
from pyspark.sql import functions as F

from cartwheel.operators import quality as Q
from cartwheel.plans import views as V
from cartwheel.sources import schemas as S


def test_orphans_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,), (9,), (9,)], "k long")
    parent = spark.createDataFrame([(1,), (2,)], "p long")
    found = Q.orphan_keys(child, parent, "k", "p").collect()
    assert [(r["_key"], r.Occurrences) for r in found] == [(9, 3)]
    got = Q.orphans({"C": child, "P": parent}, [("C", "k", "P", "p"), ("P", "p", "C", "k")]).collect()
    assert [(r.Relation, r.OrphanCount) for r in got] == [("C.k", 3), ("P.p", 0)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k long")
    assert {r.k: r.Occurrences for r in Q.duplicate_keys(df, "k").collect()} == {1: 3, None: 2}
    assert Q.duplicate_rows(df, "k").first().DuplicateCount == 3


def test_rules_pass_on_null_and_count_violations(tiny):
    got = {(r.TableName, r.RuleName): r.Violations for r in Q.broken_rules(tiny, [r for r in S.check_rules() if r[0] == "Customer"]).collect()}
    assert got == {("Customer", "age_18_to_120"): 1, ("Customer", "status_known"): 0}
    rule = [("AIReport", "campaign_known", F.col("CampaignID") > 1)]
    assert Q.broken_rules(tiny, rule).first().Violations == 1


def test_null_counts(tiny):
    got = {r.RuleName: r.Violations for r in Q.null_counts(tiny, {"Customer": ["Email", "CustomerID"]}).collect()}
    assert got == {"Email": 1, "CustomerID": 0}


def test_one_membership(tiny):
    assert [r.CustomerID for r in Q.unmatched(tiny["Customer"], tiny["LoyaltyMembership"], "CustomerID").collect()] == [3]


def test_shared_values(tiny):
    row = Q.shared_values(tiny["Customer"], "Email").first()
    assert (row.SharedRows, row.SharedPct) == (2, 50.0)


def test_constant_columns(spark):
    df = spark.createDataFrame([(0, "a", None), (0, "b", None)], "zero long, text string, nothing string")
    got = {r.ColumnName: r.IsConstant for r in Q.constant_columns(df, df.columns).collect()}
    assert got == {"zero": True, "text": False, "nothing": False}


def test_stale_age(tiny):
    got = rows(Q.stale_age(tiny["Customer"], AS_OF), "CustomerID")
    assert set(got) == {2} and got[2]["CurrentAge"] == 23 and got[2]["StoredUnder18"]


def test_line_arithmetic_and_formats(tiny):
    assert Q.line_arithmetic(tiny["SalesTransactionItem"]).count() == 0
    wrong = tiny["SalesTransactionItem"].withColumn("LineTotal", F.col("LineTotal") + F.lit("0.01").cast("decimal(10,2)"))
    assert Q.line_arithmetic(wrong).count() == 4
    got = {(r.CodeLength, r.HasSpace): r.RecordCount for r in Q.text_format_mix(tiny["Customer"], "PostalCode").collect()}
    assert got == {(6, False): 3, (7, True): 1}


def test_profile(tiny):
    got = {(r.Section, r.Item): r.Value for r in Q.profile_customer_analytics(V.customer_analytics(tiny, as_of=AS_OF)).collect()}
    assert got[("rows", "row_count")] == 4 and got[("duplicates", "CustomerID")] == 0
    assert got[("missing", "DaysSinceLastPurchase")] == 1 and ("missing", "Age") not in got
    doubled = V.customer_analytics(tiny, as_of=AS_OF)
    doubled = doubled.unionByName(doubled).withColumn("Age", F.lit(130))
    got = {(r.Section, r.Item): r.Value for r in Q.profile_customer_analytics(doubled).collect()}
    assert got[("duplicates", "CustomerID")] == 4 and got[("invalid", "Age_out_of_range")] == 8


def test_tables_and_counts(tiny):
    present = {k: v for k, v in tiny.items() if k != "Product"}
    got = rows(Q.table_existence(present, ["Customer", "Product"]), "TableName")
    assert got["Customer"]["Present"] and got["Customer"]["HasRows"] and not got["Product"]["Present"]
    got = rows(Q.compare_counts(Q.row_counts(tiny, ["Customer", "Store"]), {"Customer": 4, "Store": 25}), "TableName")
    assert got["Customer"]["Matches"] and not got["Store"]["Matches"]
