"""The queries opN_<name>: each applies its operator, with production parameters, to its
whole table and returns the full result.  ``oracle_sql`` has the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import ans_store, backoff_lm, bpe_codec, chat_trees, fst_tokens, latent_leaks, line_rules, pigeonhole_join, rank_language, url_rules
from corpusmill.llm.common import materialize, parallel


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parallel(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_codec.encode_documents(_documents(spark, sf_dir), path, public_tokenizers.PATTERN, keep_ids=False)


def op2_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = parallel(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    messages = materialize(chat_trees.from_turns(turns.unionByName(probe)), "messages")
    written = materialize(chat_trees.format_paths(messages, chat_trees.paths(messages)), "conversations")
    return chat_trees.digests(chat_trees.parse(written))


def op3_ans_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return ans_store.store_and_read(_documents(spark, sf_dir), path, vocab_size=50257)


def op4_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_leaks.leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_fst_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst_tokens.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op6_pigeonhole_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pigeonhole_join.link(_documents(spark, sf_dir))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge(_documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score(_documents(spark, sf_dir)).withColumn("score", F.round("score", 6))


def op9_rank_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return rank_language.predict(docs, rank_language.learn(docs))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parallel(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
    return url_rules.apply_rules(pages, spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_trees": chat_trees.ORACLE,
        "op6_pigeonhole_join": pigeonhole_join.ORACLE,
        "op7_line_rules": line_rules.ORACLE,
        "op8_backoff_lm": backoff_lm.ORACLE,
        "op10_url_rules": url_rules.ORACLE,
    }
