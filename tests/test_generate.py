from pyspark.sql import functions as F

from cartwheel.sources import generate, schemas as S


def test_sizes_order_and_repeatability(spark):
    frames = generate.gen_dataset(spark, scale=0.01, today="2025-06-30")
    sizes = {name: df.count() for name, df in frames.items()}
    assert sizes["Customers"] == 50 and sizes["SalesTransactions"] == 750 and sizes["SalesTransactionItems"] == 2500
    assert sizes["Stores"] == 1 and sizes["CampaignResponses"] == 180
    for name, schema in S.CSV_FILES.items():
        if name in frames:
            assert set(c.split()[0] for c in schema.split(", ")) == set(frames[name].columns)
    once = sorted(map(tuple, frames["Customers"].collect()), key=str)
    again = sorted(map(tuple, generate.gen_dataset(spark, scale=0.01, today="2025-06-30")["Customers"].repartition(3).collect()), key=str)
    assert once == again
    other = generate.gen_dataset(spark, scale=0.01, seed=43, today="2025-06-30")["Customers"]
    assert sorted(map(tuple, other.collect()), key=str) != once


def test_dependencies(spark):
    frames = generate.gen_dataset(spark, scale=0.05, today="2025-06-30")
    items, txns, responses = (frames[n] for n in ("SalesTransactionItems", "SalesTransactions", "CampaignResponses"))
    lines = items.groupBy("TransactionID").agg(F.count("*").alias("n"), F.sum("LineTotal").alias("t"))
    joined = txns.join(lines, "TransactionID", "left")
    assert joined.where("n is null or n > 8 or abs(t - TransactionTotal) > 0.005").count() == 0
    assert items.where("abs(Quantity * UnitPrice - Discount - LineTotal) > 0.005 or LineTotal < 0").count() == 0
    assert responses.where("CouponUsed = 1 and EmailOpened = 0").count() == 0
    assert responses.where("(PurchaseCompleted = 1) <> (PurchaseAmount > 0)").count() == 0
    opened = responses.agg(F.avg("EmailOpened")).first()[0]
    assert abs(opened - generate.OPENED) < 0.07
    ages = frames["Customers"].agg(F.min("Age"), F.max("Age")).first()
    assert ages[0] >= 18 and ages[1] <= 85
    prices = items.join(frames["Products"].select("ProductID", F.col("UnitPrice").alias("p")), "ProductID")
    assert prices.where("UnitPrice <> p").count() == 0
