"""Full refresh: source files to repaired tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel.functions import expr as E
from cartwheel.operators import dimensions as D
from cartwheel.operators import store
from cartwheel.operators.quality import stack_rows
from cartwheel.operators.sinks import export_csv, with_defaults
from cartwheel.session import materialize
from cartwheel.sources import files, schemas as S


def recompute_totals(transactions: DataFrame, items: DataFrame) -> DataFrame:
    """Transaction total = sum of its lines, 0 without lines.  Lines are summed
    by transaction before the join, so both sides have one row per key."""
    lines = items.groupBy("TransactionID").agg(F.sum("LineTotal").alias("_lines"))
    kind = transactions.schema["TransactionTotal"].dataType
    return (
        transactions.join(lines, "TransactionID", "left")
        .withColumn("TransactionTotal", F.coalesce(F.col("_lines"), F.lit(0)).cast(kind))
        .select(*transactions.columns)
    )


def recompute_age(customers: DataFrame, as_of=None) -> DataFrame:
    """Replace the stored age by 365-day years up to the load."""
    return customers.withColumn("Age", E.age_at_load(F.col("DateOfBirth"), as_of))


def read_sources(spark: SparkSession, folder: str, accepted_only: bool = False) -> dict[str, DataFrame]:
    read = files.scan_accepted if accepted_only else files.scan_source
    return {name: read(spark, folder, name) for name in S.CSV_FILES}


def stage_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every line of the source files, parsed once and stored as columns with
    ``_rejected``.  Rejects, lookups, totals and tables then read those and no
    text a second time."""
    return dict(zip(S.CSV_FILES, _side_by_side(
        lambda name: materialize(files.scan_csv_checked(spark, f"{folder}/{name}.csv", S.CSV_FILES[name]), "staged"), S.CSV_FILES)))


def stored_lookups(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The lookup tables of an earlier load; the seeds where there is none."""
    dims, paths = {}, store.published(spark, target)
    for name in S.SEEDS:
        found = store.read_or_none(spark, paths.get(name, f"{target}/{name}"))
        dims[name] = files.seed_table(spark, name) if found is None else found
    return dims


def build_lookups(sources: dict[str, DataFrame], case_insensitive: bool = False,
                  known: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Lookup tables: those ``known`` (by default the seeds) and the names the
    sources add to them.  Known names keep their ids."""
    spark = sources["Stores"].sparkSession
    dims = dict(known) if known else {name: files.seed_table(spark, name) for name in S.SEEDS}
    for name, (text, dim, name_column, id_column) in S.STAGED_FILES.items():
        dims[dim] = D.upsert_missing(sources[name], text, dims[dim], name_column, id_column, case_insensitive)
    return dims


def build_tables(sources: dict[str, DataFrame], dims: dict[str, DataFrame], *, as_of=None, recompute_ages: bool = True,
                 case_insensitive: bool = False) -> dict[str, DataFrame]:
    """Lazy tables of one load.  Lookup texts become ids, campaign types follow
    from the discount, transaction totals and ages are recomputed."""
    resolved = {
        name: D.resolve_key(sources[name], text, dims[dim], name_column, id_column, case_insensitive)
        for name, (text, dim, name_column, id_column) in S.STAGED_FILES.items()
    }
    responses = sources["CampaignResponses"].withColumns(
        {flag: F.col(flag).cast("boolean") for flag in ("EmailOpened", "CouponUsed", "PurchaseCompleted")}
    )
    customers = sources["Customers"]
    tables = {
        "Store": sources["Stores"],
        "ProductCategory": sources["ProductCategories"],
        "Product": sources["Products"],
        "Customer": recompute_age(customers, as_of) if recompute_ages else customers,
        "LoyaltyMembership": resolved["LoyaltyMemberships"],
        "Employee": sources["Employees"],
        "MarketingCampaign": D.resolve_campaign_type(resolved["MarketingCampaigns"], dims["CampaignType"]),
        "SalesTransaction": recompute_totals(resolved["SalesTransactions"], sources["SalesTransactionItems"]),
        "SalesTransactionItem": sources["SalesTransactionItems"],
        "CampaignResponse": responses,
    }
    return {name: with_defaults(df, name, as_of) for name, df in tables.items()}


def _side_by_side(work, names) -> list:
    """Independent tables are written at the same time, so that small ones do
    not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return [done.result() for done in [pool.submit(work, name) for name in names]]


class TooManyRejects(ValueError):
    """A load was given up because of the lines it could not read."""


def store_rejects(staged: dict[str, DataFrame], path: str) -> int:
    """Writes the rejected lines of all source files to a table; returns their
    number.  One pass over the staged files."""
    lines = stack_rows([files.rejected_of(rows, name) for name, rows in staged.items()])
    return store.write_counted(lines, path, REJECTS).rows


REJECTS = "RejectedLine"


def load_full_refresh(spark: SparkSession, folder: str, target: str, *, case_insensitive: bool = False, max_rejects: int = 0,
                      **options) -> DataFrame:
    """Load everything into ``target`` as a new version of all its tables;
    returns the row count of each loaded table, as counted by its write.

    All or nothing: the tables are written aside and published together at the
    end, so readers see the earlier load until then and keep it if this one
    fails.  Running it again gives the same tables.  Predictions and reports of
    the earlier load are cleared; lookup names keep the ids of the earlier
    load, so that an id once exported stays valid.

    A malformed line fails the load.  With ``max_rejects`` up to so many lines
    go to the table ``RejectedLine`` with the reason instead, and the load goes
    on without them; with more it raises ``TooManyRejects``.

    The rules of the model are checked by the very writes (``store.violations``
    lists the counts).  Lookup tables are stored first and read back: the facts
    then carry the stored ids, and their lookup texts are not scanned again.
    """
    load_id, fresh = store.new_load(target)
    rejected = []
    if max_rejects:
        staged = stage_sources(spark, folder)
        lines = store_rejects(staged, f"{fresh}/{REJECTS}")
        if lines > max_rejects:
            raise TooManyRejects(f"{lines} lines rejected, {max_rejects} allowed")
        rejected.append(store.Written(REJECTS, lines))
    rules: dict[str, list] = {}
    for table, rule, condition in S.check_rules():
        rules.setdefault(table, []).append((rule, condition))

    def write(frames):
        return _side_by_side(lambda name: store.write_counted(frames[name], f"{fresh}/{name}", name, rules.get(name, ())), frames)

    sources = {name: files.accepted_of(rows) for name, rows in staged.items()} if max_rejects else read_sources(spark, folder)
    lookups = build_lookups(sources, case_insensitive, stored_lookups(spark, target))
    written = write(lookups)
    dims = {name: spark.read.parquet(f"{fresh}/{name}") for name in S.SEEDS}
    written += write(build_tables(sources, dims, case_insensitive=case_insensitive, **options))
    for name in S.CLEARED_TABLES:
        files.empty_table(spark, name).write.parquet(f"{fresh}/{name}")
        written.append(store.Written(name, 0))
    store.publish(spark, target, load_id, rejected + written, options.get("as_of"))
    return store.row_counts(spark, target, S.LOADED_TABLES)


def export_sources(tables: dict[str, DataFrame], folder: str) -> None:
    """Write canonical tables back as the ten source files (lookup ids become
    their names again), for hand-over to another load."""
    named = {
        "Stores": tables["Store"],
        "ProductCategories": tables["ProductCategory"],
        "Products": tables["Product"],
        "Customers": tables["Customer"],
        "Employees": tables["Employee"],
        "SalesTransactionItems": tables["SalesTransactionItem"],
        "CampaignResponses": tables["CampaignResponse"],
    }
    sources = {"LoyaltyMemberships": "LoyaltyMembership", "MarketingCampaigns": "MarketingCampaign",
               "SalesTransactions": "SalesTransaction"}
    for name, (text, dim, name_column, id_column) in S.STAGED_FILES.items():
        lookup = tables[dim].select(id_column, F.col(name_column).alias(text))
        named[name] = tables[sources[name]].join(lookup, id_column)

    def export(name):
        schema = StructType.fromDDL(S.CSV_FILES[name])
        export_csv(named[name].select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), f"{folder}/{name}.csv")

    _side_by_side(export, named)
