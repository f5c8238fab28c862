"""The corpus pipeline: each stage is written as Parquet and read again as the next one's input.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns
of documents.  Rows that a stage rejects are gone for the ones behind it; line cleaning
replaces a kept document's text, and n_chars with it.

Verdicts belong to rows, told apart by a 64-bit hash of doc_id and text: rows without doc_id
are judged like others, and texts under one doc_id each by itself.  Of linked rows one is
left, that with the smallest doc_id, one without doc_id only if no other is linked to it; of
rows with the same doc_id and text one is left behind that stage, the least by its columns.

Defined results: null texts have no letter and go at the first stage; empty tables stay empty;
extra columns come along to the last stage but one, whatever their names, and end there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe_codec, common, latent_leaks, line_rules, pigeonhole_join, rank_language


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language is found (operator 9); lang stays what it was.

    Only null texts and texts without a single letter have none; the score rejects nothing.
    """
    found = rank_language.predict(_keyed(docs), rank_language.learn(docs)).filter(F.col("lang_pred") == rank_language.UNKNOWN)
    return _without(docs, found.select("doc_id").distinct())


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass, with the lines that pass (operator 7)."""
    judged = line_rules.judge(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text")])
    kept = judged.filter("kept").withColumnRenamed("clean", "text").withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, with the smallest id, of each group of linked ones (operator 6)."""
    linked = common.materialize(pigeonhole_join.link(_keyed(docs)).select(F.col("doc_id").alias("key"), "component_id").distinct(), "linked")
    rows = common.materialize(docs.groupBy(_key(docs).alias("key")).agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")), "rows")
    least = linked.join(rows, "key").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))).getField("key").alias("first"))
    copies = linked.join(least.select(F.col("first").alias("key")), "key", "left_anti").select(F.col("key").alias("doc_id"))
    kept = _without(docs, copies)
    # Rows with the same doc_id and text: only they are shuffled.
    repeated = common.materialize(rows.filter("rows > 1").select(F.col("key").alias("doc_id")), "repeated")
    several = kept.withColumn("_key", _key(kept)).join(repeated.select(F.col("doc_id").alias("_key")), "_key", "left_semi")
    one = several.groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return _without(kept, repeated).unionByName(one)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without an item of the benchmark (operator 4)."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, latent_leaks.leaks(_keyed(docs), benchmark, basis=latent_leaks.fit(docs)).select("doc_id").distinct())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and packed ids of what is left (operator 1)."""
    return bpe_codec.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _key(docs: DataFrame) -> Column:
    return F.xxhash64(docs.doc_id, docs.text)


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with their key, which is never null, for a doc_id."""
    return docs.withColumn("doc_id", _key(docs))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is not among ``keys`` (doc_id), which are few beside them: up to
    ``BROADCAST_IDS`` they are broadcast, beyond it the join is shuffled."""
    keys = common.materialize(keys.select(F.col("doc_id").alias("_key")), "rejected")
    if keys.count() <= pigeonhole_join.BROADCAST_IDS:
        keys = F.broadcast(keys)
    return docs.withColumn("_key", _key(docs)).join(keys, "_key", "left_anti").select(*docs.columns)


def _settled(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, on executors that have given back what the ones before it took."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.settle(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language", _settled(identify_language)),
    ("quality", _settled(apply_quality_rules)),
    ("near_copies", _settled(drop_near_copies)),
    ("leaks", _settled(remove_benchmark_leaks)),
    ("encode", _settled(encode)),
]

#: The sets of linked documents and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
