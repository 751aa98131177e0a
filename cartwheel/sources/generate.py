"""Source tables made up for tests, from the rules that the model's checks state.

Every value is a function of the row's id and a seed: digits of a hash, looked
up in small tables.  The same rows come out on any number of executors.  Rules
that tie values together hold by construction: a product's price is cost plus
margin, a membership's points are visits times fixed amounts and its level
follows from them, a response is one stage of a ladder, a transaction's total
is the sum of its lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions import expr as E
from cartwheel.operators.sinks import export_csv
from cartwheel.sources.schemas import CSV_FILES, SEEDS

# Rows of each id space at scale 1: the published size of the data set.
SIZES = {
    "Store": 25, "Product": 500, "Customer": 5_000, "Employee": 250, "MarketingCampaign": 40,
    "SalesTransaction": 75_000, "SalesTransactionItem": 250_000, "CampaignResponse": 18_000,
}
CATEGORIES = ["Bread", "Dairy", "Drinks", "Frozen", "Fruit", "Household", "Meat", "Snacks"]
TOWNS = {"North": ["Ashford", "Brookton"], "East": ["Carlow", "Dunmere"], "South": ["Elmstead", "Farleigh"], "West": ["Glenrock"]}
WORDS = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "heath", "inlet", "jetty", "knoll"]
# A channel and a payment method that no seed holds, so that a load has names to add.
UNSEEDED_CHANNEL, UNSEEDED_PAYMENT = "Push Notification", "Credit Card"
CHANNELS = [UNSEEDED_CHANNEL, *SEEDS["MarketingChannel"][2]]
PAYMENTS = [UNSEEDED_PAYMENT, *SEEDS["PaymentMethod"][2]]
COST_CENTS = [65, 80, 110, 145, 190, 250, 320, 475, 690, 1250]
MARGIN_CENTS = [15, 20, 35, 60, 95]
POINTS_A_VISIT, VISITS_A_REWARD = 40, 12
LEVEL_FROM = [2_000, 5_000, 8_000]  # lifetime points of the second and later levels
# Of ten responses: how far each goes.  (opened, coupon used, bought)
STAGES = [(0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 1), (1, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1), (1, 1, 1)]
OPENED = sum(opened for opened, _, _ in STAGES) / len(STAGES)
FIRST_DAY, OPENING_MINUTE, OPEN_MINUTES = "2024-02-01", 8 * 60 + 30, 12 * 60


class Digits:
    """Numbers from a column's value, a purpose and the seed."""

    def __init__(self, key: str, seed: int):
        self.key, self.seed = key, seed

    def below(self, purpose: str, n) -> Column:
        """0 to n - 1; n may be a column."""
        return F.pmod(F.xxhash64(F.lit(purpose), F.col(self.key), F.lit(self.seed)), F.lit(n) if isinstance(n, int) else n)

    def of(self, purpose: str, values: Sequence) -> Column:
        return _at(values, self.below(purpose, len(values)))


def _at(values: Sequence, spot: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), spot.cast("int"))


def _cents(amount: Column) -> Column:
    return (amount.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("double")


def _in_file_order(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[column.split()[0] for column in CSV_FILES[name].split(", ")])


def id_spaces(spark: SparkSession, scale: float = 1.0) -> dict[str, DataFrame]:
    """Ids 1..n per table, n at the given scale, at least 1."""
    return {name: spark.range(1, max(1, round(n * scale)) + 1) for name, n in SIZES.items()}


def _price_cents(product: Digits) -> tuple[Column, Column]:
    """Cost and price of a product, from its id alone: a line knows them too."""
    cost = product.of("cost", COST_CENTS)
    return cost, cost + product.of("margin", MARGIN_CENTS)


def _campaign_days(campaign: Digits, weeks: Column) -> tuple[Column, Column]:
    """First and last day of a campaign: it starts in some week and runs for one
    to five."""
    start = F.date_add(F.lit(FIRST_DAY).cast("date"), (campaign.below("week", weeks) * 7).cast("int"))
    return start, F.date_add(start, (campaign.below("length", 5) * 7 + 6).cast("int"))


def gen_dataset(spark: SparkSession, *, scale: float = 1.0, seed: int = 42, today: str = "2025-06-30",
                ids: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The ten source tables, named as their files.  ``ids`` may bring own id
    frames (one long column ``id``; foreign keys are drawn from 1..row count)."""
    ids = ids or id_spaces(spark, scale)
    day = F.lit(today).cast("date")
    days = F.datediff(day, F.lit(FIRST_DAY).cast("date")) + 1
    weeks = F.greatest((days / 7).cast("int") - 6, F.lit(1))
    count = {name: frame.agg(F.count("*")).scalar() for name, frame in ids.items()}

    def rows(name: str, key: str) -> tuple[DataFrame, Digits]:
        return ids[name].select(F.col("id").alias(key)), Digits(key, seed)

    def one_of(draw: Digits, name: str) -> Column:
        return draw.below(name, count[name]) + 1

    towns = [(town, province) for province, names in TOWNS.items() for town in names]

    def town(draw: Digits) -> dict[str, Column]:
        spot = draw.below("town", len(towns))
        return {"City": _at([t for t, _ in towns], spot), "Province": _at([p for _, p in towns], spot)}

    def person(draw: Digits) -> dict[str, Column]:
        return {"FirstName": F.initcap(draw.of("given", WORDS)), "LastName": F.initcap(draw.of("family", WORDS))}

    made = {}
    df, d = rows("Store", "StoreID")
    made["Stores"] = df.withColumns(town(d) | {"StoreName": F.format_string("%s %04d", d.of("store", WORDS), F.col("StoreID"))})

    entries = F.array(*[F.struct(F.lit(i).alias("CategoryID"), F.lit(n).alias("CategoryName")) for i, n in enumerate(CATEGORIES, 1)])
    made["ProductCategories"] = spark.range(1, numPartitions=1).select(F.inline(entries))

    df, d = rows("Product", "ProductID")
    cost, price = _price_cents(d)
    made["Products"] = df.withColumns({
        "ProductName": F.concat_ws(" ", d.of("look", WORDS), F.lit("no."), "ProductID"), "CategoryID": d.below("category", len(CATEGORIES)) + 1,
        "Brand": F.upper(d.of("brand", WORDS)), "UnitPrice": _cents(price), "UnitCost": _cents(cost)})

    df, d = rows("Customer", "CustomerID")
    status = d.below("status", 16)
    customers = df.withColumns(person(d) | town(d) | {
        "Gender": d.of("gender", ["Male", "Female", "Non-binary"]),
        "DateOfBirth": F.date_sub(F.add_months(day, F.lit(-12 * 19)), d.below("born", 60 * 365).cast("int")),
        "Phone": F.format_string("555-%05d", d.below("phone", 100_000)),
        "PostalCode": F.concat_ws(" ", F.hex(d.below("post", 4096)), F.hex(d.below("code", 256))),
        "RegistrationDate": F.date_sub(day, d.below("since", 2500).cast("int")),
        "CustomerStatus": F.when(status == 0, "Suspended").when(status < 4, "Inactive").otherwise("Active"),
    }).withColumns({
        "Age": E.age_years(F.col("DateOfBirth"), today),
        "Email": F.format_string("c%d@mail.example", F.col("CustomerID")),
        "Address": F.concat_ws(" ", d.below("number", 300) + 1, d.of("street", WORDS), F.lit("Road")),
    })
    made["Customers"] = customers

    visits = d.below("visits", 260)
    made["LoyaltyMemberships"] = customers.select("CustomerID", "RegistrationDate").withColumns({
        "LoyaltyNumber": F.format_string("M-%010d", F.col("CustomerID")),
        "LifetimePointsEarned": visits * POINTS_A_VISIT,
        # every reward costs the points of its visits; some are not taken
        "LifetimePointsRedeemed": F.floor(d.below("taken", visits + 1) / VISITS_A_REWARD) * (VISITS_A_REWARD * POINTS_A_VISIT),
        "JoinDate": F.least(F.date_add("RegistrationDate", d.below("joined", 90).cast("int")), day),
    }).withColumns({
        "CurrentPoints": F.col("LifetimePointsEarned") - F.col("LifetimePointsRedeemed"),
        "MembershipLevel": _at(SEEDS["LoyaltyLevel"][2], sum(((F.col("LifetimePointsEarned") >= least).cast("int") for least in LEVEL_FROM), F.lit(0))),
    })

    df, d = rows("Employee", "EmployeeID")
    made["Employees"] = df.withColumns(person(d) | {"Role": d.of("role", ["Buyer", "Clerk", "Cook", "Driver"]), "StoreID": one_of(d, "Store")})

    df, d = rows("MarketingCampaign", "CampaignID")
    first, last = _campaign_days(d, weeks)
    made["MarketingCampaigns"] = df.withColumns({
        "CampaignName": F.concat_ws(" ", d.of("season", WORDS), F.lit("offer"), "CampaignID"), "Channel": d.of("channel", CHANNELS),
        "StartDate": first, "EndDate": last, "DiscountPercent": (d.below("percent", 9) * 5).cast("double")})

    # The first lines go to one transaction each, the later ones round again.
    df, d = rows("SalesTransactionItem", "TransactionItemID")
    _cost, price = _price_cents(Digits("ProductID", seed))
    gross = F.col("Quantity") * F.col("_price")
    items = df.withColumns({
        "TransactionID": F.pmod(F.col("TransactionItemID") - 1, count["SalesTransaction"]) + 1,
        "ProductID": one_of(d, "Product"), "Quantity": d.below("quantity", 5) + 1,
    }).withColumn("_price", price).withColumn(
        # one line in eight is on offer, at a tenth to four tenths off
        "_off", F.when(d.below("offer", 8) == 0, F.floor(gross * (d.below("tenths", 4) + 1) / 10)).otherwise(0)
    ).withColumns({"UnitPrice": _cents(F.col("_price")), "Discount": _cents(F.col("_off")), "LineTotal": _cents(gross - F.col("_off"))})
    made["SalesTransactionItems"] = items

    totals = items.groupBy("TransactionID").agg(_cents(F.sum(gross - F.col("_off"))).alias("TransactionTotal"))
    df, d = rows("SalesTransaction", "TransactionID")
    moment = F.make_dt_interval(d.below("day", days).cast("int"), F.lit(0), (d.below("minute", OPEN_MINUTES) + OPENING_MINUTE).cast("int"))
    made["SalesTransactions"] = df.withColumns({
        "CustomerID": one_of(d, "Customer"), "StoreID": one_of(d, "Store"), "PaymentMethod": d.of("payment", PAYMENTS),
        "TransactionDate": F.lit(FIRST_DAY).cast("timestamp_ntz") + moment,
    }).join(totals, "TransactionID", "left").withColumn("TransactionTotal", E.zero_f(F.col("TransactionTotal")))

    df, d = rows("CampaignResponse", "ResponseID")
    first, last = _campaign_days(Digits("CampaignID", seed), weeks)
    stage = d.below("stage", len(STAGES))
    opened, coupon, bought = (_at([s[i] for s in STAGES], stage) for i in range(3))
    made["CampaignResponses"] = df.withColumns({
        "CampaignID": one_of(d, "MarketingCampaign"), "CustomerID": one_of(d, "Customer"), "EmailOpened": opened, "CouponUsed": coupon,
        "PurchaseCompleted": bought, "PurchaseAmount": _cents(bought * (d.below("spent", 24_000) + 500)),
    }).withColumn("ResponseDate", F.date_add(first, d.below("after", F.datediff(last, first) + 1).cast("int")).cast("timestamp_ntz"))
    return {name: _in_file_order(df, name) for name, df in made.items()}


def write_sources(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Headered CSV under the source file names."""
    for name, df in frames.items():
        export_csv(df, f"{folder}/{name}.csv")
