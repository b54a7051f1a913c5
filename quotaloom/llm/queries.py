"""The corpus operators as queries over the driver's tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quotaloom.llm import (
    exact_dedup,
    fingerprints,
    html_text,
    langid,
    mixing,
    packing,
    repair_files,
    secret_scan,
    simhash,
    spelling,
    suffix_dedup,
    toxicity,
    vector_codes,
)
from quotaloom.llm.common import documents
from quotaloom.llm.tokens import tokenizer_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_exact_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.find_near_groups(documents(spark, sf_dir))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select(F.col("id").alias("doc_id"), fingerprint.alias("fingerprint"), "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit_by_fold(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (toxicity.fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    mixed, sources = mixing.mix_with_targets(docs, F.array("source"))
    named = mixed.withColumn("name", mixed.members[0])
    of = sources.withColumnRenamed("name", "of")
    if of.count() <= mixing.BROADCAST_PATTERNS:  # else a shuffle, whose hot sources AQE splits
        of = F.broadcast(of)
    out = named.join(of, F.col("name").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return suffix_dedup.with_digest(removed).withColumnRenamed("id", "doc_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    part = toxicity.fold("doc_id", 3)
    model = langid.fit(docs.select("doc_id", "text", "lang").where(part != 1))
    known = langid.with_language(docs.select("doc_id", "text"), model)
    return known.select("doc_id", (part == 1).alias("held_out"), "lang_pred", "score")


def op9_repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = repair_files.write_shards(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return repair_files.document_index(shards)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edit(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_text.main_text(pages.select("page_id", "url", "html"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    coded, books = vector_codes.train_and_encode(vectors, others=("label",))
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d)
    out = coded.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), error.alias("error"))
    out = vector_codes.with_group_error(out, "error", "label", "label_error")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_toxicity": op5_toxicity,
    "op6_source_mixing": op6_source_mixing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_repair_files": op9_repair_files,
    "op10_minhash": op10_minhash,
    "op11_html_text": op11_html_text,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}
