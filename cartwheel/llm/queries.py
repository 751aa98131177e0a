"""The operators with their production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import bpe, language, manifest, neighbours, packing, passages, periods, rules, sharding, simhash, sql, suffixes, topk, toxicity
from cartwheel.llm.common import id_remainder, stored, table
from cartwheel.llm.components import components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op6_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of equal row counts; see ``sharding.shard_rows``."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    return sharding.shard_rows(docs, ["doc_id", "size", "text_crc32"], shards=24, seed=17).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


@query
def op9_bpe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every text and of the text decoded from them."""
    path = vocabulary_path()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, path), path)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learnt without the held-out fifth of the rows."""
    learnt = id_remainder("doc_id", 5) != 0
    return toxicity.fit(docs.where(learnt), labels.where(learnt))


@query
def op5_pu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all texts by positive-unlabelled learning."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def language_model(docs: DataFrame) -> language.Model:
    """Learnt without the held-out third of the rows."""
    return language.fit(docs.where(id_remainder("doc_id", 3) != 1))


@query
def op7_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Main language of every text and its share."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    return language.predict(docs.select("doc_id", "text"), language_model(docs)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_simhash_gray(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3, bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query
def op8_configuration_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 ids."""
    return packing.pack_texts(table(spark, folder, "documents"), vocabulary_path(), capacity=2048)


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes seen before."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffixes.without_repeats(docs, depth=100).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every document and the verdict of the learnt rules."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged, _ = rules.judge(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op10_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of every twentieth embedding."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op1_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words or more that near-repeat in an earlier document,
    exact ones by the first document that holds them, and the component of each
    document."""
    found = stored(passages.near_passages(table(spark, folder, "documents"), words=5, least_words=50, similar=0.8, connect=True), "passages")
    roots = components(found.select("doc_id", "other"), "doc_id", "other")
    return found.join(roots, found["doc_id"] == roots["node"]).select(
        "doc_id", F.col("other").alias("other_doc_id"), "start", "n_words", F.col("other_start").alias("other_start"), "n_other_words",
        "similarity", F.col("root").alias("component_id"))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, held against a copy in
    which a fifth of the texts has lost its capitals."""

    def leaf(text: Column) -> Column:
        return manifest.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    docs = table(spark, folder, "documents")
    copy = F.when(id_remainder("doc_id", 5) == 0, leaf(F.translate("text", ascii_uppercase, ascii_lowercase)))
    made = manifest.build(docs, leaf(F.col("text")), given=copy)
    root = F.lit(None if made.root is None else made.root.hex()).cast("string")
    return manifest.prove(made).select(
        F.col("key").alias("doc_id"), F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"), F.lower(F.hex("folded")).alias("folded_root"),
        (F.lower(F.hex("folded")) == root).alias("verified"))


ORACLE["op11_merkle_manifest"] = sql.merkle_manifest(levels=6, tops=4)


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words in every text; a tenth of the texts is made
    periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    docs = table(spark, folder, "documents").select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
    text = F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text"))
    found = periods.periodic_runs(docs.select("doc_id", text.alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        F.col("key").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"), F.expr("(1000 * best.length) div (-best.col3)").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


ORACLE["op12_periodic_runs"] = sql.PERIODIC_RUNS


@query
def op13_uniform_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 rows with the largest inner product of every fiftieth embedding."""
    return topk.top(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


ORACLE["op13_uniform_threshold"] = sql.TOP_PRODUCTS
