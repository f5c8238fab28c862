"""Rewards, group-normalised advantages and policy losses over rollout tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X


def reward(completion: Column, truth: Column, max_new_tokens: int, correct_weight: float = 1.0, format_weight: float = 0.3) -> Column:
    """Struct of reward, correct, has_think, has_answer, truncated."""
    said, gold = X.answer_of(completion), X.answer_of(F.coalesce(truth, F.lit("")))
    x, y = X.number_of(gold), X.number_of(said)
    close = F.abs(x - y) <= F.greatest(F.lit(1e-3) * F.greatest(F.abs(x), F.abs(y)), F.lit(1e-4))
    correct = F.when(x.isNotNull() & y.isNotNull(), close).otherwise((gold != "") & (F.lower(gold) == F.lower(said)))
    think, has, cut = X.balanced_think(completion), said != "", F.length(completion) >= 4 * max_new_tokens
    value = F.when(cut & ~has, 0.0).when(correct & think, correct_weight).when(correct, 0.5 * correct_weight).when(think & has & ~cut, format_weight).otherwise(0.0)
    return F.struct(value.alias("reward"), correct.cast("int").alias("correct"), think.cast("int").alias("has_think"), has.cast("int").alias("has_answer"), cut.cast("int").alias("truncated"))


def advantage(df: DataFrame, by: str, value: str = "reward") -> DataFrame:
    """Adds ``advantage``: the value less its group's mean, over the sample deviation, which
    is at least 1e-4.  A group is as large as the samples drawn for one prompt."""
    g = df.groupBy(F.col(by).alias("_by")).agg(F.avg(value).alias("_mean"), F.greatest(F.coalesce(F.stddev_samp(value), F.lit(0.0)), F.lit(1e-4)).alias("_std"))
    return df.join(g, df[by].eqNullSafe(g["_by"])).withColumn("advantage", (F.col(value) - F.col("_mean")) / F.col("_std")).drop("_by", "_mean", "_std")


def policy_loss(tokens: DataFrame, clip: float, kl_weight: float) -> DataFrame:
    """One row (pg, kl, loss, ratio_mean) from rows (advantage, logp, ref_logp, mask)."""
    m = F.col("mask").cast("double")
    log_ratio = (F.col("logp") - F.col("ref_logp")) * m
    ratio, adv = F.exp(log_ratio), F.col("advantage")
    pg = -F.least(adv * ratio, adv * F.greatest(F.lit(1 - clip), F.least(F.lit(1 + clip), ratio))) * m
    kl = (ratio - log_ratio - 1) * m
    n = F.greatest(F.sum(m), F.lit(1.0))
    return tokens.agg((F.sum(pg) / n).alias("pg"), (F.sum(kl) / n).alias("kl"), F.avg(ratio).alias("ratio_mean")).withColumn("loss", F.col("pg") + kl_weight * F.col("kl"))


def masked_mean(value: Column, mask: Column) -> Column:
    return F.sum(value * mask) / F.greatest(F.sum(mask), F.lit(1))


def nucleus(logits: DataFrame, by: str, top_k: int, top_p: float) -> DataFrame:
    """Tokens left by top-k (ties of the k-th stay) and then top-p (the first always stays)."""
    order = Window.partitionBy(by).orderBy(F.desc("logit"))
    kept = logits.withColumn("_rank", F.rank().over(order)).filter(F.col("_rank") <= top_k)
    top = Window.partitionBy(by)
    e = F.exp(F.col("logit") - F.max("logit").over(top))
    p = kept.withColumn("p", e / F.sum(e).over(top))
    running = Window.partitionBy(by).orderBy(F.desc("logit"), "token").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("_cum", F.sum("p").over(running)).withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("logit"), "token")))
    return p.filter((F.col("_cum") <= top_p) | (F.col("_n") == 1)).drop("_rank", "_cum", "_n")


def records(stream: DataFrame, by: str, end_id: int = 0) -> DataFrame:
    """Adds ``record`` to packed tokens (by, pos, token, mask): a separator is an end id with
    mask 0 behind a record that has mask 1; a last record without mask 1 is dropped."""
    order = Window.partitionBy(by).orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sep = ((F.col("token") == end_id) & (F.col("mask") == 0)).cast("int")
    d = stream.withColumn("_seg", F.coalesce(F.sum(sep).over(before), F.lit(0)))
    d = d.withColumn("_has", F.max("mask").over(Window.partitionBy(by, "_seg")))
    valid = sep * F.col("_has")
    d = d.withColumn("record", F.coalesce(F.sum(valid).over(before), F.lit(0)).cast("long"))
    d = d.withColumn("_any", F.max("mask").over(Window.partitionBy(by, "record")))
    return d.filter("_any = 1").drop("_seg", "_has", "_any")


def penalised(logits: DataFrame, generated: DataFrame, by: str, penalty: float) -> DataFrame:
    """Logits with those of tokens generated before made smaller: divided by the penalty above
    zero, multiplied below."""
    seen = generated.select(by, "token").distinct().withColumn("_seen", F.lit(True))
    x = F.col("logit")
    smaller = F.when(x > 0, x / penalty).otherwise(x * penalty)
    return logits.join(seen, [by, "token"], "left").withColumn("logit", F.when(F.col("_seen"), smaller).otherwise(x)).drop("_seen")


def greedy(logits: DataFrame, by: str) -> DataFrame:
    """The token with the largest logit of each row, the smallest of equal ones."""
    return logits.groupBy(by).agg(F.max_by("token", F.struct("logit", -F.col("token"))).alias("token"))


def cross_entropy(tokens: DataFrame) -> DataFrame:
    """One row: loss and accuracy over tokens under the mask, from (logp, hit, mask)."""
    return tokens.agg(masked_mean(-F.col("logp"), F.col("mask")).alias("loss"), masked_mean(F.col("hit").cast("double"), F.col("mask")).alias("accuracy"), F.sum("mask").cast("long").alias("tokens"))


def per_log(metrics: DataFrame, step: str, every: int, *values: str) -> DataFrame:
    """Means of the values since the last log, a log every so many steps."""
    return metrics.groupBy(F.floor(F.col(step) / every).alias("log")).agg(F.count("*").alias("n"), *[F.avg(v).alias(v) for v in values])


def sampled_prompts(prompts: DataFrame, order: list[str], batch: int, batches: int, seed: int) -> DataFrame:
    """batch, slot and the row of prompts drawn with replacement: draws are hashes, joined to the
    rows by number."""
    from corpusmill.operators import packing

    numbered = packing.running_offset(prompts, order, F.lit(1)).withColumnRenamed("offset", "number")
    n = prompts.count()
    slots = prompts.sparkSession.range(batches * batch).select(F.floor(F.col("id") / batch).alias("batch"), (F.col("id") % batch).alias("slot"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(n, 1))).alias("number"))
    return slots.join(numbered, "number").drop("number")


def usable_prompts(df: DataFrame, prompt_ids: str, truth: str, most: int) -> DataFrame:
    """Prompts shorter than ``most`` ids that have an answer."""
    return df.filter((F.size(prompt_ids) < most) & (F.coalesce(F.col(truth), F.lit("")) != ""))
