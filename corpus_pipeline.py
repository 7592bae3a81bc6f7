"""Corpus preparation from ``documents`` to shards, five stages of the operators in ``corpuslab.llm``.

A stage takes what its predecessor kept and returns rows with the columns of ``documents`` (the last one adds shard and
slot). Between stages the rows are written to the folder that executors share and read again, so a lost executor costs
at most the current stage.

Edge cases are those of the operators; columns beyond those of ``documents`` are carried along, and an empty table
passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.llm import decontaminate, jaccard, langid, mixing, sharding
from corpuslab.llm.common import row_marked, table
from corpuslab.session import scratch_path

ORACLE_SQL = None
LEAST_SCORE = 0.3  # below this no language is a fair guess
SHARDS = 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that no language fits; the model learns from the input's labels."""
    model = langid.train(docs.select("doc_id", "text", "lang"))
    names = {"lang_pred", "score"} & set(docs.columns)
    plain = docs.withColumnsRenamed({c: f"_own_{c}" for c in names})
    kept = langid.predict(plain, model).filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.drop("lang_pred", "score").withColumnsRenamed({f"_own_{c}": c for c in names}).select(*docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: five-word shingles, Jaccard 0.8."""
    return jaccard.one_per_component(docs, k=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold at least half of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources, languages and topics reach their (flattened) shares of tokens."""
    return mixing.sample(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, sources interleaved in proportion. Narrow rows are ranked; texts move once."""
    marked, _ = row_marked(docs, mark="_row_mark")
    places = sharding.interleave(marked.select("_row_mark", "source"), SHARDS, key="_row_mark").select("_row_mark", "shard", "slot")
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    return marked.select("_row_mark", *own).join(places.hint("merge"), "_row_mark").drop("_row_mark")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
