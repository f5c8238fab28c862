"""Readers: JSON lines, hub rows, chat turns and training logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X

# Columns that hold text, prompts, answers, code and conversations, and role names.
TEXT_COLUMNS = ["text", "content", "document", "article", "body", "passage", "abstract", "sentence", "description"]
PROMPT_COLUMNS = ["prompt", "question", "instruction", "input", "query", "problem", "task"]
ANSWER_COLUMNS = ["answer", "response", "output", "completion", "solution", "answers"]
CODE_COLUMNS = ["code", "solution_code", "func_code", "program"]
USER_ROLES = ["human", "user", "prompter"]
ASSISTANT_ROLES = ["gpt", "assistant", "bot", "model"]

PRETRAIN = "text string, source string, category string, content_type string"
PAIRS = "prompt string, thinking string, answer string, source string, category string"


def json_shards(spark: SparkSession, folder: str, schema: str = PRETRAIN, required: str = "text") -> DataFrame:
    """Records of <folder>/<category>/*.jsonl; malformed lines, and those without the
    required column, are skipped."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(f"{folder}/*/*.jsonl")
    return rows.filter(F.coalesce(F.col(required), F.lit("")) != "")


def write_json_shards(df: DataFrame, folder: str, by: str = "category", most_records: int = 0) -> None:
    df.write.partitionBy(by).option("maxRecordsPerFile", most_records).mode("append").json(folder)


def first_text(df: DataFrame, names: list[str]) -> Column:
    """The first of the named columns, whatever their case, that has text, trimmed."""
    have = {c.lower(): c for c, kind in df.dtypes if kind == "string"}
    found = [F.nullif(X.strip(F.col(f"`{have[n]}`")), F.lit("")) for n in names if n in have]
    return F.coalesce(*found, F.lit(None).cast("string"))


def suitable(df: DataFrame, hints: dict[str, str] | None = None) -> bool:
    """Whether a table's columns can be mapped to records at all."""
    known = {*TEXT_COLUMNS, *PROMPT_COLUMNS, *ANSWER_COLUMNS, *CODE_COLUMNS, "conversations", "messages", "conversation"}
    return bool(hints) or any(c.lower() in known for c in df.columns)


def as_records(df: DataFrame, source: str, hints: dict[str, str] | None = None) -> DataFrame:
    """Rows of any table as (text, prompt, answer, source), resolved when the plan is built:
    a text column, else prompt and answer, else all strings joined."""
    hints = hints or {}
    prompt = first_text(df, [hints["prompt"].lower()] if "prompt" in hints else PROMPT_COLUMNS)
    answer = first_text(df, [hints["answer"].lower()] if "answer" in hints else ANSWER_COLUMNS)
    text = first_text(df, [hints["text"].lower()] if "text" in hints else TEXT_COLUMNS + CODE_COLUMNS)
    every = F.concat_ws("\n", *[F.nullif(X.strip(F.col(f"`{c}`")), F.lit("")) for c, kind in df.dtypes if kind == "string"])
    pair = F.when(prompt.isNotNull() & answer.isNotNull(), F.concat(prompt, F.lit("\n\n"), answer))
    return df.select(F.coalesce(text, pair, every).alias("text"), prompt.alias("prompt"), answer.alias("answer"), F.lit(source).alias("source"))


def capped(df: DataFrame, by: str, order: str, most: int) -> DataFrame:
    """At most max(1, most // groups) rows of each group, the first in order."""
    n = df.select(by).distinct().count()
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order))).filter(F.col("_n") <= max(1, most // max(n, 1))).drop("_n")


def first_exchange(turns: DataFrame) -> DataFrame:
    """conv_id, prompt, answer: the first user turn and the first assistant turn behind it."""
    role = F.lower("role")
    said = F.coalesce(X.strip(F.col("text")), F.lit("")) != ""
    user = turns.filter(role.isin(USER_ROLES) & said).groupBy("conv_id").agg(F.min("turn").alias("at"), F.min_by("text", "turn").alias("prompt"))
    told = turns.filter(role.isin(ASSISTANT_ROLES) & said).select("conv_id", "turn", F.col("text").alias("answer"))
    return told.join(user, "conv_id").filter("turn > at").groupBy("conv_id").agg(F.first("prompt").alias("prompt"), F.min_by("answer", "turn").alias("answer"))


def training_log(spark: SparkSession, path: str) -> DataFrame:
    """step, loss, lr, ktok_s, mfu of log lines that have them."""
    line = F.col("value")
    number = r"([0-9.eE+-]+)"
    get = lambda pattern: F.nullif(F.regexp_extract(line, pattern, 1), F.lit(""))
    rows = spark.read.text(path).filter(line.rlike(r"step\s+[0-9,]+"))
    return rows.select(F.regexp_replace(get(r"step\s+([0-9,]+)"), ",", "").cast("long").alias("step"), get(r"loss\s+" + number).cast("double").alias("loss"), get(r"lr\s+" + number).cast("double").alias("lr"), get(number + r"k tok/s").cast("double").alias("ktok_s"), get(r"mfu\s+" + number).cast("double").alias("mfu"))
