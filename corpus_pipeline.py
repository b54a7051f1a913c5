"""Corpus pipeline: each stage calls one operator on what the stage before it kept.

Stages take (spark, docs, sf_dir) and return the columns of ``documents``, the last one its
packed pieces. ``run`` writes each stage's rows to the shared scratch folder and goes on from
the written table, as the driver does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.llm import exact_dedup, mixing, packing, simhash, toxicity
from quotaloom.llm.common import documents, fresh, stored
from quotaloom.llm.tokens import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts toxic go; it learns from the labels of the documents given."""
    model = toxicity.fit_by_fold(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (score,) = fresh(docs, "_toxic")
    return toxicity.with_score(docs, model, name=score).where(F.col(score) < 0.5).drop(score)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest original stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash fingerprints at most three bits apart, the smallest id stays."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it: not at all, once, or repeated."""
    return mixing.take(docs, F.array("source"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 4096 ids."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact),
    ("simhash_dedup", drop_near),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

#: Learned scores, fingerprints and token ids are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
