"""Training corpus: filter, deduplicate and pack the documents.

Each stage takes (spark, docs, folder of tables) and returns a DataFrame, which
is written and read again before the next one.  All stages but the last return
the columns of ``documents``.  Rows with NULLs, empty texts and repeated ids
are treated as the operators' docstrings say; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm import language, packing, simhash, suffixes, toxicity
from cartwheel.llm.common import importable, stored, table
from cartwheel.llm.queries import language_model, toxicity_model, vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC_FROM = 0.5
LEAST_SHARE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    model = toxicity_model(docs.select("doc_id", "text"), table(spark, folder, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model, result="_score").where(F.col("_score") < TOXIC_FROM).select(*COLUMNS)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents at least half of which is in one learnt language; texts
    without a letter go."""
    importable(spark)
    model = language_model(docs.select("doc_id", "text", "lang"))
    judged = language.predict(docs.select(*COLUMNS), model, lang="_lang", share="_share")
    return judged.where((F.col("_lang") != language.UNKNOWN) & (F.col("_share") >= LEAST_SHARE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest id (NULL last) of each group of near
    duplicates, that with the smallest hash if texts share the id, once if its
    row is repeated."""
    importable(spark)
    rows = docs.select(*COLUMNS).withColumn("_hash", F.xxhash64("text"))
    found = simhash.near_duplicates(rows, words=3, bits=2, carry=("_hash",), root="_root")
    first = found.groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash")).alias("m")).select(
        F.col("m.doc_id").alias("_id"), F.col("m._hash").alias("_own"))
    same = Window.partitionBy("doc_id", "_hash").orderBy("source", "lang")
    return rows.join(first, rows["doc_id"].eqNullSafe(first["_id"]) & (rows["_hash"] == first["_own"])).withColumn(
        "_copy", F.row_number().over(same)).where("_copy = 1").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the strings of 100 bytes or more that also start
    earlier, cut at whole characters.  A document may be left empty; a NULL
    text becomes empty."""
    importable(spark)
    left = suffixes.without_repeats(docs.select(*COLUMNS), depth=100, carry=("lang", "source"), whole_characters=True)
    text = F.col("kept").cast("string")
    return left.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 ids."""
    importable(spark)
    return packing.pack_texts(docs, vocabulary_path(), capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeats),
    ("best-fit packing", pack),
]

# Learnt models and hashed comparisons are not expressible in SQL; the stages
# are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on the whole table of documents."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, folder), "stage")
    return docs
