"""Declared shape of the 17 tables and the 10 source files: columns, keys,
relations, defaults, seeds and rules.

The lists below are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

# -- source files -------------------------------------------------------------
# File -> columns in file order.  0/1 flags are read as int and cast on load.
CSV_FILES = {
    "Stores": "StoreID bigint, StoreName string, City string, Province string",
    "ProductCategories": "CategoryID bigint, CategoryName string",
    "Products": "ProductID bigint, ProductName string, CategoryID bigint, Brand string,"
    " UnitPrice decimal(10,2), UnitCost decimal(10,2)",
    "Customers": "CustomerID bigint, FirstName string, LastName string, Gender string, DateOfBirth date, Age int,"
    " Email string, Phone string, Address string, City string, Province string, PostalCode string,"
    " RegistrationDate date, CustomerStatus string",
    "LoyaltyMemberships": "LoyaltyNumber string, CustomerID bigint, MembershipLevel string, JoinDate date,"
    " CurrentPoints int, LifetimePointsEarned int, LifetimePointsRedeemed int",
    "Employees": "EmployeeID bigint, FirstName string, LastName string, Role string, StoreID bigint",
    "MarketingCampaigns": "CampaignID bigint, CampaignName string, Channel string, StartDate date, EndDate date,"
    " DiscountPercent decimal(5,2)",
    "SalesTransactions": "TransactionID bigint, CustomerID bigint, StoreID bigint, TransactionDate timestamp_ntz,"
    " PaymentMethod string, TransactionTotal decimal(10,2)",
    "SalesTransactionItems": "TransactionItemID bigint, TransactionID bigint, ProductID bigint, Quantity int,"
    " UnitPrice decimal(10,2), Discount decimal(10,2), LineTotal decimal(10,2)",
    "CampaignResponses": "ResponseID bigint, CampaignID bigint, CustomerID bigint, EmailOpened int, CouponUsed int,"
    " PurchaseCompleted int, PurchaseAmount decimal(10,2), ResponseDate timestamp_ntz",
}

# File whose lookup column is text -> (lookup column, lookup table, name, id)
STAGED_FILES = {
    "LoyaltyMemberships": ("MembershipLevel", "LoyaltyLevel", "LevelName", "LoyaltyLevelID"),
    "MarketingCampaigns": ("Channel", "MarketingChannel", "ChannelName", "MarketingChannelID"),
    "SalesTransactions": ("PaymentMethod", "PaymentMethod", "MethodName", "PaymentMethodID"),
}

# Names the lookup tables start with, ids from 1 in this order.
SEEDS = {
    "LoyaltyLevel": ("LoyaltyLevelID", "LevelName", ["Bronze", "Silver", "Gold", "Platinum"]),
    "PaymentMethod": ("PaymentMethodID", "MethodName", ["Cash", "Credit", "Debit", "Mobile Payment"]),
    "MarketingChannel": (
        "MarketingChannelID", "ChannelName", ["Email", "SMS", "Mobile App", "Social Media", "Direct Mail"],
    ),
    "CampaignType": (
        "CampaignTypeID", "TypeName", ["Deep Discount", "Standard Discount", "Loyalty/Retention", "Awareness"],
    ),
}

# -- tables -------------------------------------------------------------------
TABLES = [
    "Store", "ProductCategory", "LoyaltyLevel", "PaymentMethod", "MarketingChannel", "CampaignType",
    "Customer", "LoyaltyMembership", "Employee", "Product", "MarketingCampaign", "SalesTransaction",
    "SalesTransactionItem", "CampaignResponse", "CustomerPrediction", "AIReport", "ModelExecution",
]

# Tables a load fills, in report order.
LOADED_TABLES = [
    "Store", "ProductCategory", "Product", "Customer", "LoyaltyMembership", "Employee", "MarketingCampaign",
    "SalesTransaction", "SalesTransactionItem", "CampaignResponse",
]

# Tables that later runs append to.
ANALYTIC_TABLES = {
    "CustomerPrediction": "PredictionID bigint, CustomerID bigint, PredictionDate timestamp_ntz,"
    " PredictionProbability decimal(5,4), PredictionResult string, MLModel string, ModelVersion string",
    "AIReport": "AIReportID bigint, ReportType string, CampaignID bigint, GeneratedDate timestamp_ntz, ModelName string,"
    " PromptVersion string, ReportText string, Approved boolean",
    "ModelExecution": "ExecutionID bigint, ExecutionDate timestamp_ntz, Algorithm string, Accuracy decimal(5,4),"
    " Precision_ decimal(5,4), Recall decimal(5,4), F1Score decimal(5,4), ExecutionDurationSeconds decimal(10,2)",
}
# Decisions on reports, newest last.
DECISIONS = "AIReportDecision"
DECISION_SCHEMA = "DecisionID bigint, AIReportID bigint, Approved boolean, DecidedDate timestamp_ntz"
# Emptied by a full refresh; the log of model runs is kept.
CLEARED_TABLES = ["CustomerPrediction", "AIReport", DECISIONS]

BI_TABLES = [
    "Customer", "Product", "ProductCategory", "Store", "SalesTransaction", "SalesTransactionItem",
    "MarketingCampaign", "CampaignResponse", "CustomerPrediction", "AIReport", "ModelExecution",
]

# (child, key, parent, parent key)
FOREIGN_KEYS = [
    ("LoyaltyMembership", "CustomerID", "Customer", "CustomerID"),
    ("LoyaltyMembership", "LoyaltyLevelID", "LoyaltyLevel", "LoyaltyLevelID"),
    ("Employee", "StoreID", "Store", "StoreID"),
    ("Product", "CategoryID", "ProductCategory", "CategoryID"),
    ("MarketingCampaign", "MarketingChannelID", "MarketingChannel", "MarketingChannelID"),
    ("MarketingCampaign", "CampaignTypeID", "CampaignType", "CampaignTypeID"),
    ("SalesTransaction", "CustomerID", "Customer", "CustomerID"),
    ("SalesTransaction", "StoreID", "Store", "StoreID"),
    ("SalesTransaction", "PaymentMethodID", "PaymentMethod", "PaymentMethodID"),
    ("SalesTransactionItem", "TransactionID", "SalesTransaction", "TransactionID"),
    ("SalesTransactionItem", "ProductID", "Product", "ProductID"),
    ("CampaignResponse", "CampaignID", "MarketingCampaign", "CampaignID"),
    ("CampaignResponse", "CustomerID", "Customer", "CustomerID"),
    ("CustomerPrediction", "CustomerID", "Customer", "CustomerID"),
    ("AIReport", "CampaignID", "MarketingCampaign", "CampaignID"),
]

# The relations checked after every load.
LOAD_CHECK_KEYS = [
    ("SalesTransaction", "CustomerID", "Customer", "CustomerID"),
    ("SalesTransactionItem", "ProductID", "Product", "ProductID"),
    ("SalesTransactionItem", "TransactionID", "SalesTransaction", "TransactionID"),
    ("CampaignResponse", "CampaignID", "MarketingCampaign", "CampaignID"),
    ("CampaignResponse", "CustomerID", "Customer", "CustomerID"),
]

UNIQUE_COLUMNS = [
    ("LoyaltyLevel", "LevelName"),
    ("PaymentMethod", "MethodName"),
    ("MarketingChannel", "ChannelName"),
    ("CampaignType", "TypeName"),
    ("LoyaltyMembership", "LoyaltyNumber"),
]

NOT_NULL = {
    "Store": ["StoreID", "StoreName", "City", "Province"],
    "ProductCategory": ["CategoryID", "CategoryName"],
    "Customer": ["CustomerID", "FirstName", "LastName", "DateOfBirth", "Age", "RegistrationDate", "CustomerStatus"],
    "LoyaltyMembership": [
        "CustomerID", "LoyaltyNumber", "LoyaltyLevelID", "JoinDate", "CurrentPoints", "LifetimePointsEarned",
        "LifetimePointsRedeemed",
    ],
    "Employee": ["EmployeeID", "FirstName", "LastName", "Role", "StoreID"],
    "Product": ["ProductID", "ProductName", "CategoryID", "UnitPrice", "UnitCost"],
    "MarketingCampaign": [
        "CampaignID", "CampaignName", "MarketingChannelID", "StartDate", "EndDate", "DiscountPercent",
    ],
    "SalesTransaction": [
        "TransactionID", "CustomerID", "StoreID", "TransactionDate", "PaymentMethodID", "TransactionTotal",
    ],
    "SalesTransactionItem": [
        "TransactionItemID", "TransactionID", "ProductID", "Quantity", "UnitPrice", "Discount", "LineTotal",
    ],
    "CampaignResponse": [
        "ResponseID", "CampaignID", "CustomerID", "EmailOpened", "CouponUsed", "PurchaseCompleted", "PurchaseAmount",
        "ResponseDate",
    ],
    "CustomerPrediction": [
        "PredictionID", "CustomerID", "PredictionDate", "PredictionProbability", "PredictionResult", "MLModel",
        "ModelVersion",
    ],
    "AIReport": ["AIReportID", "ReportType", "GeneratedDate", "ModelName", "PromptVersion", "ReportText", "Approved"],
    "ModelExecution": [
        "ExecutionID", "ExecutionDate", "Algorithm", "Accuracy", "Precision_", "Recall", "F1Score",
        "ExecutionDurationSeconds",
    ],
}

# Value of a column that is missing when a row is stored; "now" is the moment
# of the write.
DEFAULTS = {
    "Customer": {"CustomerStatus": "Active"},
    "LoyaltyMembership": {"CurrentPoints": 0, "LifetimePointsEarned": 0, "LifetimePointsRedeemed": 0},
    "SalesTransactionItem": {"Discount": 0},
    "CampaignResponse": {"EmailOpened": False, "CouponUsed": False, "PurchaseCompleted": False, "PurchaseAmount": 0},
    "CustomerPrediction": {"PredictionDate": "now"},
    "AIReport": {"GeneratedDate": "now", "Approved": False},
    "ModelExecution": {"ExecutionDate": "now"},
}


def check_rules():
    """(table, rule, condition that must not be FALSE)"""
    c = F.col
    unit = [c(m).between(0, 1) for m in ("Accuracy", "Precision_", "Recall", "F1Score")]
    return [
        ("Customer", "age_18_to_120", c("Age").between(18, 120)),
        ("Customer", "status_known", c("CustomerStatus").isin("Active", "Inactive", "Suspended")),
        ("Product", "price_not_negative", c("UnitPrice") >= 0),
        ("Product", "cost_not_negative", c("UnitCost") >= 0),
        ("MarketingCampaign", "percent_0_to_100", c("DiscountPercent").between(0, 100)),
        ("MarketingCampaign", "end_after_start", c("EndDate") >= c("StartDate")),
        ("SalesTransaction", "total_not_negative", c("TransactionTotal") >= 0),
        ("SalesTransactionItem", "quantity_positive", c("Quantity") > 0),
        ("SalesTransactionItem", "price_not_negative", c("UnitPrice") >= 0),
        ("SalesTransactionItem", "discount_not_negative", c("Discount") >= 0),
        ("SalesTransactionItem", "line_total_not_negative", c("LineTotal") >= 0),
        ("CampaignResponse", "amount_not_negative", c("PurchaseAmount") >= 0),
        (
            "LoyaltyMembership", "points_not_negative",
            (c("CurrentPoints") >= 0) & (c("LifetimePointsEarned") >= 0) & (c("LifetimePointsRedeemed") >= 0),
        ),
        ("CustomerPrediction", "probability_0_to_1", c("PredictionProbability").between(0, 1)),
        ("CustomerPrediction", "result_known", c("PredictionResult").isin("Yes", "No")),
        ("ModelExecution", "metrics_0_to_1", unit[0] & unit[1] & unit[2] & unit[3]),
    ]


def range_rules():
    """The four range rules checked after every load."""
    wanted = {
        ("CampaignResponse", "amount_not_negative"), ("MarketingCampaign", "percent_0_to_100"),
        ("Customer", "age_18_to_120"), ("SalesTransaction", "total_not_negative"),
    }
    return [rule for rule in check_rules() if rule[:2] in wanted]
