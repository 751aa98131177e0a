import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.session import build_session  # noqa: E402
from cartwheel.sources import files  # noqa: E402

AS_OF = "2024-02-01 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session("local[8]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
                            spark__ui__showConsoleProgress="false", spark__checkpoint__dir=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def tiny(spark):
    """Literal tables with the edge cases: a customer without anything (3), a
    transaction without lines (13), a campaign never sent (3), one without
    discount (2), tied response dates (customer 1), a level no one knows."""
    d = Decimal

    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "Store": df([(1, "S1", "A", "North"), (2, "S2", "B", "South")], "StoreID long, StoreName string, City string, Province string"),
        "ProductCategory": df([(1, "Dairy"), (2, "Bakery")], "CategoryID long, CategoryName string"),
        "LoyaltyLevel": df([(1, "Bronze"), (4, "Platinum"), (9, "Diamond")], "LoyaltyLevelID long, LevelName string"),
        "MarketingChannel": files.seed_table(spark, "MarketingChannel"),
        "CampaignType": files.seed_table(spark, "CampaignType"),
        "PaymentMethod": files.seed_table(spark, "PaymentMethod"),
        "Customer": df(
            [(1, "A", "One", date(2000, 2, 1), 24, "x@e", "North", "K1A1B1", date(2023, 1, 1), "Active"),
             (2, "B", "Two", date(2000, 2, 2), 17, "x@e", "North", "K1A 1B1", date(2023, 6, 1), "Inactive"),
             (3, "C", "Three", date(2000, 1, 31), 24, "y@e", "South", "K1A1B2", date(2024, 2, 1), "Active"),
             (4, "D", "Four", date(1990, 12, 31), 33, None, "South", "K1A1B3", date(2020, 1, 1), "Active")],
            "CustomerID long, FirstName string, LastName string, DateOfBirth date, Age int, Email string, Province string,"
            " PostalCode string, RegistrationDate date, CustomerStatus string"),
        "LoyaltyMembership": df([(1, "L1", 1, 5), (2, "L2", 9, 0), (4, "L4", 4, 7)],
                                "CustomerID long, LoyaltyNumber string, LoyaltyLevelID long, CurrentPoints int"),
        "Product": df([(1, "Milk", 1, d("2.00"), d("1.50")), (2, "Bread", 2, d("3.00"), d("1.00"))],
                      "ProductID long, ProductName string, CategoryID long, UnitPrice decimal(10,2), UnitCost decimal(10,2)"),
        "MarketingCampaign": df(
            [(1, "Big", 1, 1, date(2024, 1, 1), date(2024, 1, 9), d("30.00")), (2, "Free", 2, 4, date(2024, 1, 1), date(2024, 1, 9), d("0.00")),
             (3, "Unsent", 3, 2, date(2024, 1, 1), date(2024, 1, 9), d("15.00")), (4, "Dull", 1, 3, date(2024, 1, 1), date(2024, 1, 9), d("5.00"))],
            "CampaignID long, CampaignName string, MarketingChannelID long, CampaignTypeID long, StartDate date, EndDate date, DiscountPercent decimal(5,2)"),
        "SalesTransaction": df(
            [(10, 1, 1, ts("2024-01-31 23:59:00"), 1, d("10.00")), (11, 1, 2, ts("2024-01-10 10:00:00"), 1, d("5.01")),
             (12, 2, 1, ts("2023-08-01 00:00:00"), 2, d("7.00")), (13, 4, 1, ts("2023-07-31 23:00:00"), 2, d("0.00"))],
            "TransactionID long, CustomerID long, StoreID long, TransactionDate timestamp_ntz, PaymentMethodID long, TransactionTotal decimal(10,2)"),
        "SalesTransactionItem": df(
            [(1, 10, 1, 2, d("2.00"), d("0.50"), d("3.50")), (2, 10, 2, 1, d("3.00"), d("0.00"), d("3.00")),
             (3, 11, 1, 1, d("2.00"), d("0.00"), d("2.00")), (4, 12, 2, 3, d("3.00"), d("1.00"), d("8.00"))],
            "TransactionItemID long, TransactionID long, ProductID long, Quantity int, UnitPrice decimal(10,2), Discount decimal(10,2), LineTotal decimal(10,2)"),
        "CampaignResponse": df(
            [(1, 1, 1, True, True, True, d("20.00"), ts("2024-01-05 00:00:00")), (2, 2, 1, True, False, False, d("0.00"), ts("2024-01-05 00:00:00")),
             (3, 1, 2, False, False, False, d("0.00"), ts("2024-01-06 00:00:00")), (4, 2, 2, True, False, True, d("30.00"), ts("2024-01-07 00:00:00")),
             (5, 4, 4, True, False, False, d("0.00"), ts("2024-01-08 00:00:00"))],
            "ResponseID long, CampaignID long, CustomerID long, EmailOpened boolean, CouponUsed boolean, PurchaseCompleted boolean,"
            " PurchaseAmount decimal(10,2), ResponseDate timestamp_ntz"),
        "CustomerPrediction": df(
            [(1, 1, ts("2024-01-01 00:00:00"), d("0.9000"), "Yes", "M", "v"), (2, 1, ts("2024-01-09 00:00:00"), d("0.5000"), "Yes", "M", "v"),
             (3, 2, ts("2024-01-09 00:00:00"), d("0.7000"), "Yes", "M", "v"), (4, 3, ts("2024-01-09 00:00:00"), d("0.1000"), "No", "M", "v")],
            "PredictionID long, CustomerID long, PredictionDate timestamp_ntz, PredictionProbability decimal(5,4), PredictionResult string,"
            " MLModel string, ModelVersion string"),
        "ModelExecution": df(
            [(1, ts("2024-01-01 00:00:00"), "RF", d("0.7"), d("0.6"), d("0.5"), d("0.4"), d("3")), (2, ts("2024-01-02 00:00:00"), "RF", d("0.8"), d("0.7"), d("0.6"), d("0.5"), d("3"))],
            "ExecutionID long, ExecutionDate timestamp_ntz, Algorithm string, Accuracy decimal(5,4), Precision_ decimal(5,4), Recall decimal(5,4),"
            " F1Score decimal(5,4), ExecutionDurationSeconds decimal(10,2)"),
        "AIReport": df(
            [(1, "Executive Summary", None, ts("2024-01-01 00:00:00"), "m", "v1", "Revenue was 1,000.50 from 7 stores", False),
             (2, "Campaign Analysis", 1, ts("2024-01-02 00:00:00"), "m", "v1", "2 customers, 99 dogs", False),
             (3, "Executive Summary", None, ts("2024-01-03 00:00:00"), "m", "v1", "  ", True)],
            "AIReportID long, ReportType string, CampaignID long, GeneratedDate timestamp_ntz, ModelName string, PromptVersion string,"
            " ReportText string, Approved boolean"),
    }


def rows(df, key):
    """Rows as dicts by key."""
    return {r[key]: r.asDict() for r in df.collect()}
