"""The canonical tables and named datasets in SQL, written independently of the
DataFrame code.  In query texts ``@Name`` stands for one of them."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
SALES_AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"


def values(names, id_column, name_column):
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names, 1))
    return f"SELECT CAST(i AS BIGINT) AS {id_column}, n AS {name_column} FROM (VALUES {rows}) v(i, n)"


def money(expr, scale=2):
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def age(birth, as_of=AS_OF):
    return (
        f"(year({as_of}) - year({birth}) - CASE WHEN month({birth}) > month({as_of}) OR (month({birth}) = month({as_of})"
        f" AND day({birth}) > day({as_of})) THEN 1 ELSE 0 END)"
    )


def days(moment, as_of=AS_OF):
    return f"date_diff('day', CAST({moment} AS DATE), CAST({as_of} AS DATE))"


def count_if(cond):
    return f"count(CASE WHEN {cond} THEN 1 END)"


def pct(part, whole):
    return f"(CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0.0))"


def ratio(a, b):
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0.0))"


def half_up(x, digits):
    p = float(10**digits)
    return f"(floor({x} * {p} + 0.5) / {p})"


def percent_text(x):
    return f"printf('%.1f%%', {half_up(x, 1)})"


def dollars_text(x):
    return f"('$' || format('{{:,.2f}}', {half_up(x, 2)}))"


_DOB = "(DATE '1940-01-01' + CAST(c_custkey * 7919 % 22000 AS INT))"
_UNIT = "CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2))"
_DISCOUNT = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))"
_PROB = "CAST(((c_custkey * 37 + run * 11) % 101) / 100.0 AS DECIMAL(5,4))"


def _metric(step):
    return f"CAST((6000 + s_suppkey * {step} % 3000) / 10000.0 AS DECIMAL(5,4))"



CANON = {
    "Store": "SELECT CAST(n_nationkey AS BIGINT) AS StoreID, 'Store ' || n_name AS StoreName, n_name AS City,"
    " r_name AS Province FROM nation JOIN region ON n_regionkey = r_regionkey",
    "ProductCategory": values(["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"], "CategoryID", "CategoryName"),
    "LoyaltyLevel": values(["Bronze", "Silver", "Gold", "Platinum", "Household"], "LoyaltyLevelID", "LevelName"),
    "PaymentMethod": values(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "PaymentMethodID", "MethodName"),
    "MarketingChannel": values(["Email", "SMS", "Mobile App", "Social Media", "Direct Mail"], "MarketingChannelID", "ChannelName"),
    "CampaignType": values(["Deep Discount", "Standard Discount", "Loyalty/Retention", "Awareness"], "CampaignTypeID", "TypeName"),
    "Customer": f"""SELECT c_custkey AS CustomerID, split_part(c_name, '#', 1) AS FirstName, split_part(c_name, '#', 2) AS LastName,
        CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Non-binary' END AS Gender,
        {_DOB} AS DateOfBirth, CAST(floor(date_diff('day', {_DOB}, DATE '2012-01-01') / 365.0) AS BIGINT) AS Age,
        printf('user%d@example.com', c_custkey % 1400) AS Email, printf('555-%04d', c_custkey % 10000) AS Phone,
        printf('%d Main St', c_custkey % 9990 + 10) AS Address, n_name AS City, r_name AS Province,
        printf('K%dA%s%dB%d', c_custkey % 10, CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE '' END, c_custkey % 7, c_custkey % 9) AS PostalCode,
        DATE '1990-01-01' + CAST(c_custkey % 1500 AS INT) AS RegistrationDate,
        CASE WHEN c_custkey % 20 = 0 THEN 'Suspended' WHEN c_custkey % 20 <= 2 THEN 'Inactive' ELSE 'Active' END AS CustomerStatus
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "LoyaltyMembership": """SELECT CustomerID, LoyaltyNumber, LoyaltyLevelID, JoinDate, earned - redeemed AS CurrentPoints,
        earned AS LifetimePointsEarned, redeemed AS LifetimePointsRedeemed FROM (
        SELECT c_custkey AS CustomerID, printf('LM%06d', c_custkey) AS LoyaltyNumber,
        CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'MACHINERY' THEN 4
             WHEN 'HOUSEHOLD' THEN 5 ELSE 0 END AS BIGINT) AS LoyaltyLevelID,
        DATE '1990-01-01' + CAST(c_custkey % 1500 + c_custkey % 100 AS INT) AS JoinDate,
        c_custkey * 37 % 20000 AS earned, CAST(floor((c_custkey * 37 % 20000) * (c_custkey % 10) / 10.0) AS BIGINT) AS redeemed
        FROM customer) m""",
    "Employee": """SELECT s_suppkey AS EmployeeID, split_part(s_name, '#', 1) AS FirstName, split_part(s_name, '#', 2) AS LastName,
        CASE s_suppkey % 5 WHEN 0 THEN 'Till Lead' WHEN 1 THEN 'Floor Staff' WHEN 2 THEN 'Buyer'
        WHEN 3 THEN 'Driver' ELSE 'Analyst' END AS Role, CAST(s_nationkey AS BIGINT) AS StoreID FROM supplier""",
    "Product": """SELECT p_partkey AS ProductID, p_name AS ProductName,
        CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5
             WHEN 'STANDARD' THEN 6 ELSE 0 END AS BIGINT) AS CategoryID, p_brand AS Brand,
        CAST(p_retailprice AS DECIMAL(10,2)) AS UnitPrice,
        CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS UnitCost FROM part""",
    "MarketingCampaign": """SELECT p_partkey AS CampaignID, 'Promotion of ' || p_name || ' ' || p_partkey AS CampaignName,
        p_partkey % 5 + 1 AS MarketingChannelID,
        CAST(CASE WHEN p_partkey % 40 >= 30 THEN 1 WHEN p_partkey % 40 >= 15 THEN 2 WHEN p_partkey % 40 > 0 THEN 3 ELSE 4 END AS BIGINT) AS CampaignTypeID,
        DATE '2024-01-01' + CAST(p_partkey % 10 AS INT) AS StartDate, DATE '2024-01-15' + CAST(p_partkey % 10 AS INT) AS EndDate,
        CAST(p_partkey % 40 AS DECIMAL(5,2)) AS DiscountPercent FROM part""",
    "SalesTransaction": """SELECT o_orderkey AS TransactionID, o_custkey AS CustomerID, o_orderkey % 25 AS StoreID,
        o_orderdate AS TransactionDate, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS PaymentMethodID,
        CAST(o_totalprice AS DECIMAL(10,2)) AS TransactionTotal FROM orders""",
    "SalesTransactionItem": f"""SELECT l_orderkey * 10 + l_linenumber AS TransactionItemID, l_orderkey AS TransactionID,
        l_partkey AS ProductID, CAST(l_quantity AS BIGINT) AS Quantity, {_UNIT} AS UnitPrice, {_DISCOUNT} AS Discount,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - {_DISCOUNT} AS DECIMAL(18,4)) AS LineTotal FROM lineitem""",
    "CampaignResponse": """SELECT event_id AS ResponseID, CAST(json_extract_string(props, '$.k') AS BIGINT) AS CampaignID,
        user_id AS CustomerID, event_type IN ('view', 'click', 'purchase') AS EmailOpened,
        event_type IN ('click', 'purchase') AS CouponUsed, event_type = 'purchase' AS PurchaseCompleted,
        CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END AS PurchaseAmount,
        ts AS ResponseDate FROM events""",
    "CustomerPrediction": f"""SELECT c_custkey * 2 + run AS PredictionID, c_custkey AS CustomerID,
        CASE run WHEN 1 THEN TIMESTAMP '2024-01-20 06:00:00' ELSE TIMESTAMP '2024-01-27 06:00:00' END AS PredictionDate,
        {_PROB} AS PredictionProbability, CASE WHEN {_PROB} >= 0.5 THEN 'Yes' ELSE 'No' END AS PredictionResult,
        'RandomForest' AS MLModel, 'v1.0' AS ModelVersion
        FROM customer CROSS JOIN (VALUES (1), (2)) r(run)""",
    "ModelExecution": f"""SELECT s_suppkey AS ExecutionID, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey % 28 AS INT)) AS ExecutionDate,
        'RandomForest' AS Algorithm, {_metric(37)} AS Accuracy, {_metric(53)} AS Precision_, {_metric(71)} AS Recall,
        {_metric(97)} AS F1Score, CAST(s_suppkey % 600 AS DECIMAL(10,2)) AS ExecutionDurationSeconds FROM supplier""",
    "AIReport": """SELECT doc_id AS AIReportID, CASE doc_id % 5 WHEN 0 THEN 'Executive Summary' WHEN 1 THEN 'Campaign Analysis'
        WHEN 2 THEN 'Prediction Interpretation' WHEN 3 THEN 'Business Recommendations' ELSE 'Dashboard Commentary' END AS ReportType,
        CASE WHEN doc_id % 5 = 1 THEN doc_id % 100 END AS CampaignID,
        TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id % 40000 AS INT)) AS GeneratedDate,
        'report-model' AS ModelName, CASE WHEN doc_id % 2 = 0 THEN 'v1.0' ELSE 'v1.1' END AS PromptVersion,
        text AS ReportText, doc_id % 3 = 0 AS Approved FROM documents""",
    # -- named datasets -----------------------------------------------------
    "LatestResponse": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY ResponseDate DESC, ResponseID DESC) AS rn
        FROM @CampaignResponse) x WHERE rn = 1""",
    "LatestPrediction": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY PredictionDate DESC, PredictionID DESC) AS rn
        FROM @CustomerPrediction) x WHERE rn = 1""",
    "Analytics": f"""SELECT c.CustomerID, {age('c.DateOfBirth')} AS Age, c.Province, ll.LevelName AS LoyaltyLevel,
        coalesce(t.n, 0) AS NumTransactions, coalesce(t.total, 0.0) AS TotalAmountSpent,
        coalesce(t.total / t.n, 0.0) AS AveragePurchaseValue, {days('t.last')} AS DaysSinceLastPurchase,
        coalesce(r.n, 0) AS NumCampaignsReceived, coalesce({pct('r.done', 'r.n')}, 0.0) AS CampaignResponseRate,
        coalesce(p.products, 0) AS NumDistinctProductsPurchased, coalesce(p.discount / p.n, 0.0) AS AverageDiscountReceived,
        l.PurchaseCompleted
        FROM @Customer c LEFT JOIN @LoyaltyMembership m ON m.CustomerID = c.CustomerID
        LEFT JOIN @LoyaltyLevel ll ON ll.LoyaltyLevelID = m.LoyaltyLevelID
        LEFT JOIN (SELECT CustomerID, count(*) AS n, {money('TransactionTotal')} AS total, max(TransactionDate) AS last
                   FROM @SalesTransaction GROUP BY 1) t ON t.CustomerID = c.CustomerID
        LEFT JOIN (SELECT s.CustomerID, count(DISTINCT i.ProductID) AS products, {money('i.Discount', 4)} AS discount, count(i.Discount) AS n
                   FROM @SalesTransaction s JOIN @SalesTransactionItem i ON i.TransactionID = s.TransactionID GROUP BY 1) p
               ON p.CustomerID = c.CustomerID
        LEFT JOIN (SELECT CustomerID, count(*) AS n, {count_if('PurchaseCompleted')} AS done FROM @CampaignResponse GROUP BY 1) r
               ON r.CustomerID = c.CustomerID
        LEFT JOIN @LatestResponse l ON l.CustomerID = c.CustomerID""",
    "Performance": f"""SELECT mc.CampaignID, mc.CampaignName, ch.ChannelName, CAST(mc.DiscountPercent AS DOUBLE) AS DiscountPercent,
        count(r.ResponseID) AS CustomersContacted, {pct(count_if('r.EmailOpened'), 'count(r.ResponseID)')} AS OpenRate,
        {pct(count_if('r.PurchaseCompleted'), 'count(r.ResponseID)')} AS PurchaseCompletionRate,
        coalesce({money('r.PurchaseAmount')}, 0.0) AS TotalRevenueGenerated,
        coalesce({ratio(money('r.PurchaseAmount'), 'count(nullif(r.PurchaseAmount, 0))')}, 0.0) AS AveragePurchaseAmount
        FROM @MarketingCampaign mc JOIN @MarketingChannel ch ON ch.MarketingChannelID = mc.MarketingChannelID
        LEFT JOIN @CampaignResponse r ON r.CampaignID = mc.CampaignID GROUP BY 1, 2, 3, 4""",
    "SoldLines": """SELECT s.TransactionID, year(s.TransactionDate) AS SalesYear, month(s.TransactionDate) AS SalesMonth, st.StoreID,
        st.StoreName, st.Province, pc.CategoryID, pc.CategoryName, i.LineTotal, i.Quantity
        FROM @SalesTransaction s JOIN @Store st ON st.StoreID = s.StoreID JOIN @SalesTransactionItem i ON i.TransactionID = s.TransactionID
        JOIN @Product p ON p.ProductID = i.ProductID JOIN @ProductCategory pc ON pc.CategoryID = p.CategoryID""",
    "Sales": f"""SELECT SalesYear, SalesMonth, StoreID, StoreName, Province, CategoryID, CategoryName, {money('LineTotal', 4)} AS Revenue,
        CAST(sum(Quantity) AS BIGINT) AS UnitsSold, count(DISTINCT TransactionID) AS TransactionCount FROM @SoldLines GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "Ltv": f"""SELECT c.CustomerID, c.FirstName, c.LastName, coalesce(t.total, 0.0) AS TotalHistoricalSpend, coalesce(t.n, 0) AS NumTransactions,
        {days('c.RegistrationDate')} AS TenureDays, coalesce(t.total, 0.0) AS CustomerLifetimeValue
        FROM @Customer c LEFT JOIN (SELECT CustomerID, count(*) AS n, {money('TransactionTotal')} AS total FROM @SalesTransaction GROUP BY 1) t
        ON t.CustomerID = c.CustomerID""",
    "Results": """SELECT c.CustomerID, c.FirstName, c.LastName, p.PredictionDate, CAST(p.PredictionProbability AS DOUBLE) AS PredictionProbability,
        p.PredictionResult, p.MLModel, p.ModelVersion, r.PurchaseCompleted AS ActualPurchaseCompleted,
        CASE WHEN r.PurchaseCompleted IS NULL OR p.PredictionResult IS NULL THEN NULL
             ELSE (p.PredictionResult = 'Yes') = r.PurchaseCompleted END AS PredictionCorrect
        FROM @Customer c LEFT JOIN @LatestPrediction p ON p.CustomerID = c.CustomerID LEFT JOIN @LatestResponse r ON r.CustomerID = c.CustomerID""",
    "Features": """SELECT CustomerID, Age, CAST(CASE LoyaltyLevel WHEN 'Bronze' THEN 1 WHEN 'Silver' THEN 2 WHEN 'Gold' THEN 3 WHEN 'Platinum' THEN 4 ELSE 0 END AS BIGINT) AS LoyaltyLevelEncoded,
        NumTransactions, TotalAmountSpent, AveragePurchaseValue,
        coalesce(DaysSinceLastPurchase, (SELECT max(DaysSinceLastPurchase) + 1 FROM @Analytics), 9999) AS DaysSinceLastPurchase,
        NumCampaignsReceived, CampaignResponseRate, NumDistinctProductsPurchased, AverageDiscountReceived, CAST(PurchaseCompleted AS BIGINT) AS label
        FROM @Analytics""",
}

_REF = re.compile(r"@(\w+)")


def sql(text: str) -> str:
    """Expand @Names to common table expressions, dependencies first."""
    ordered: list[str] = []

    def visit(body):
        for name in _REF.findall(body):
            if name in CANON and name not in ordered:
                visit(CANON[name])
                if name not in ordered:
                    ordered.append(name)

    visit(text)
    expand = lambda body: _REF.sub(lambda m: f"t_{m.group(1)}" if m.group(1) in CANON else m.group(0), body)
    if not ordered:
        return text
    return "WITH " + ", ".join(f"t_{n} AS ({expand(CANON[n])})" for n in ordered) + " " + expand(text)
