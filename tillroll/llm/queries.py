"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import audit, chat, codes, decontaminate, language, mixing, pii, ppm, sharding, simhash, substrings, topk, toxicity
from tillroll.llm.common import fold, small_batches, table


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs, learns=fold() > 0)
    rows = docs.select("doc_id", "text", (fold() == 0).alias("held_out"))
    found = language.identified(rows, model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.with_hits(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.transform("hits", lambda h: h["item_id"]).alias("item_ids"),
        F.array_min(F.transform("hits", lambda h: h["distance"])).alias("least_distance"),
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.annotated(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
        pii.span_text(F.concat("base", "found")).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    marked = "</s>[INST] ok [/INST]"  # the text of conversation -7, full of control strings
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(marked).alias("text"),
    )
    texts = chat.format_records(chat.conversation_records(rows.unionByName(extra)))
    return chat.read_formatted(texts).withColumn("conv_id", F.col("key").cast("long")).drop("key")


def op6_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mixing.mixed(docs).select("doc_id", "source", *mixing.ADDED)


def op8_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.log_probabilities(table(spark, folder, "documents"), held=fold() == 1)


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold() == 0).alias("held_out"))
    model = toxicity.fit(docs, table(spark, folder, "labels"), learns=fold() > 0)
    found = toxicity.scored(docs, model)
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op11_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = codes.compressed(table(spark, folder, "embeddings"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return found.rows.select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(found.books_sha256()).alias("codebooks_sha256"),
    )


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


def op13_filters(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audited(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _with_small_batches(query):
    return lambda spark, folder: query(small_batches(spark), folder)


QUERIES = {
    "op1_language": op1_language,
    "op2_decontaminate": op2_decontaminate,
    "op3_pii": op3_pii,
    "op4_topk": op4_topk,
    "op5_chat": op5_chat,
    "op6_substrings": op6_substrings,
    "op7_mixing": op7_mixing,
    "op8_ppm": op8_ppm,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_codes": op11_codes,
    "op12_sharding": op12_sharding,
    "op13_filters": op13_filters,
}
QUERIES = {name: _with_small_batches(query) for name, query in QUERIES.items()}
