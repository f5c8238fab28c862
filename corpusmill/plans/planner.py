"""Sizing formulas as expressions over rows of plans."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Presets by name with non-embedding parameters, hidden size and layers.
PRESETS = [
    ("0.6B", 595_734_528, 1024, 28),
    ("1.7B", 1_721_127_424, 2048, 28),
    ("4B", 4_022_458_368, 2560, 36),
    ("8B", 8_189_737_472, 4096, 36),
    ("0.3B", 296_550_400, 768, 24),
    ("1B", 1_005_056_000, 1536, 28),
    ("3B", 3_000_000_000, 2304, 32),
    ("32B", 32_000_000_000, 5120, 64),
]
TOKENS_PER_PARAM = 20
LR_AT, BATCH_AT = 5.0e-4, 2_000_000


def step(n: Column, cuts: list[tuple[float, int]], top: int) -> Column:
    """The value beside the first cut that n lies under."""
    out = None
    for below, value in cuts:
        out = F.when(n < below, value) if out is None else out.when(n < below, value)
    return out.otherwise(top)


def batch_tokens(n: Column) -> Column:
    return step(n, [(5e8, 1_000_000), (2e9, 2_000_000), (8e9, 4_000_000)], 8_000_000)


def micro_batch(n: Column, seq_len: int) -> Column:
    half = 2 if seq_len >= 8192 else 1
    out = F.lit(1)
    for upto, mb in [(2e9, 2), (1e9, 4), (5e8, 8)]:
        out = F.when(n <= upto, max(1, mb // half)).otherwise(out)
    return out


def peak_lr(batch: Column, stage: str = "pretrain") -> Column:
    return F.lit(LR_AT * {"pretrain": 1.0, "sft": 1 / 30, "sft_lora": 1 / 30, "grpo": 1 / 100}[stage]) * F.sqrt(F.lit(float(BATCH_AT)) / batch)


def cosine_lr(at: Column, warmup: int, most: int, high: float, low: float) -> Column:
    progress = (at - warmup) / float(max(1, most - warmup))
    return F.when(at < warmup, F.lit(high) * (at + 1) / float(warmup)).when(at >= most, low).otherwise(low + 0.5 * (1 + F.cos(math.pi * progress)) * (high - low))


def mfu(params: Column, tokens_per_s: Column, peak_tflops: float) -> Column:
    return 6 * params * tokens_per_s / (peak_tflops * 1e12)


def presets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRESETS, "name string, params long, hidden int, layers int")


def nearest_preset(plans: DataFrame, target: str) -> DataFrame:
    """Adds the preset whose size is nearest in proportion; presets are a handful of literals."""
    distance = [F.struct(F.abs(F.log(F.lit(float(n)) / F.col(target))).alias("d"), F.lit(i).alias("i"), F.lit(name).alias("name")) for i, (name, n, *_) in enumerate(PRESETS)]
    return plans.withColumn("preset", F.array_min(F.array(*distance))["name"])


def pretrain_plan(plans: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Parameters, preset, batch, steps, warm-up, learning rate, operations and verdict."""
    t = F.col(tokens)
    p = plans.withColumn("params", F.round(t / TOKENS_PER_PARAM).cast("long"))
    p = nearest_preset(p, "params").withColumn("batch", batch_tokens(F.col("params")).cast("long"))
    p = p.withColumn("steps", F.greatest(F.lit(1), F.floor(t / F.col("batch"))).cast("long"))
    p = p.withColumn("warmup", F.greatest(F.lit(100), F.floor(F.col("steps") / 100)).cast("long"))
    return p.withColumn("lr", peak_lr(F.col("batch"))).withColumn("flops", 6.0 * F.col("params") * t)


def verdict(tokens: Column, params: Column) -> Column:
    r = tokens / params
    return F.when(r < 15, "below").when(r > 25, "above").otherwise("ok")


def budgets(mix: DataFrame, target: int) -> DataFrame:
    """(category, weight) to byte budgets; a null weight counts 1/n; weights sum to 1 then."""
    n = mix.withColumn("_n", F.expr("count(*) over ()"))  # a row per category
    w = n.withColumn("weight", F.coalesce("weight", 1.0 / F.col("_n"))).drop("_n")
    return w.withColumn("fraction", F.col("weight") / F.expr("sum(weight) over ()")).withColumn("budget", F.floor(F.col("fraction") * target).cast("long")).drop("weight")


def param_count(hidden: Column, layers: Column, inner: Column, heads: Column, kv_heads: Column, head_dim: Column, vocab: Column, tied: Column) -> Column:
    """Parameters of a gated decoder without biases: attention with normalised queries and
    keys, three matrices per inner layer, two norms per layer and one at the end."""
    width = heads * head_dim
    attention = 2 * hidden * width + 2 * hidden * kv_heads * head_dim + 2 * head_dim
    layer = attention + 3 * hidden * inner + 2 * hidden
    return vocab * hidden * F.when(tied, 1).otherwise(2) + layers * layer + hidden


def parse_params(text: Column) -> Column:
    """Parameters of "0.6B", "600M", "5K", "1000"."""
    s = F.upper(F.regexp_replace(text, r"\s", ""))
    number = F.regexp_extract(s, r"^([0-9.]+)", 1).cast("double")
    factor = F.when(F.endswith(s, F.lit("B")), 1e9).when(F.endswith(s, F.lit("M")), 1e6).when(F.endswith(s, F.lit("K")), 1e3).otherwise(1.0)
    return F.floor(number * factor).cast("long")


# Raw bytes per token where nothing is measured.
BYTES_PER_TOKEN = {"pretrain": 5.0, "sft": 8.0, "grpo": 6.0}


def bytes_per_token(source_bytes: Column, tokens: Column, stage: str) -> Column:
    measured = F.when((source_bytes > 0) & (tokens > 0), source_bytes / tokens)
    return F.coalesce(measured, F.lit(BYTES_PER_TOKEN[stage]))


def human_bytes(n: Column) -> Column:
    out = F.format_string("%d B", n.cast("long"))
    for power, unit in enumerate(("KB", "MB", "GB", "TB", "PB"), 1):
        out = F.when(n >= 1000**power, F.format_string(f"%.2f {unit}", n / float(1000**power))).otherwise(out)
    return out


def sft_plan(plans: DataFrame, seq_len: int, micro: int, accumulate: int, world: int, epochs: int, tokens: str = "sft_tokens") -> DataFrame:
    """Batch, samples and steps an epoch, learning rate of supervised tuning on a token budget."""
    auto = max(1, round(500_000 / (micro * world * seq_len)))
    batch = micro * (accumulate or auto) * world * seq_len
    t = F.col(tokens)
    each = F.greatest(F.lit(batch), F.floor(t / max(1, epochs)))
    p = plans.withColumn("batch", F.lit(batch).cast("long")).withColumn("steps", F.greatest(F.lit(1), F.floor(each / batch)).cast("long"))
    p = p.withColumn("samples", F.greatest(F.lit(1), F.floor(F.floor(t / 600) / max(1, epochs))).cast("long"))
    return p.withColumn("lr", peak_lr(F.col("batch"), "sft")).withColumn("download", (t * BYTES_PER_TOKEN["sft"]).cast("long"))


def grpo_plan(plans: DataFrame, seq_len: int, group: int, params: str = "params") -> DataFrame:
    """Prompts (a step each), batch, learning rate, clip and response length by model size."""
    n = F.col(params)
    p = plans.withColumn("prompts", F.when(n >= 5e9, 32_000).when(n >= 1e9, 8_000).otherwise(4_000).cast("long"))
    p = p.withColumn("steps", F.col("prompts")).withColumn("batch", F.lit(group * seq_len).cast("long"))
    p = p.withColumn("lr", F.when(n < 1e9, 1.0e-6).when(n < 5e9, 7.5e-7).otherwise(5.0e-7)).withColumn("clip", F.when(n < 2e9, 0.1).otherwise(0.2))
    return p.withColumn("response", F.when(n < 2e9, 2048).otherwise(4096).cast("long")).withColumn("prompt_tokens", F.col("prompts") * 512)


# Head counts that are tried, and the ranges of layers and hidden sizes.
HEADS = [4, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 64]
LAYERS, HIDDEN = range(12, 65, 2), range(256, 8193, 64)


def architectures(targets: DataFrame, target: str = "params", vocab: int = 151_936, head_dim: int = 128, slack: float = 0.10) -> DataFrame:
    """Adds the best shape (hidden, layers, heads, kv_heads, inner, actual, score) within ``slack``
    of each target: by score, then by closeness, then by layers, hidden size and heads.

    Shapes are a grid of some ten thousand rows; targets are sizes of models, a handful, and each
    is held against all shapes.
    """
    spark = targets.sparkSession
    grid = spark.range(len(LAYERS)).select((F.col("id") * LAYERS.step + LAYERS.start).alias("layers"))
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    grid = grid.withColumn("hidden", F.explode(longs(HIDDEN))).withColumn("heads", F.explode(longs(HEADS))).withColumn("kv_heads", F.greatest(F.lit(2), F.floor(F.col("heads") / 4)).cast("long"))
    ratio = F.col("hidden") / F.col("layers")
    grid = grid.filter((ratio >= 18) & (ratio <= 180) & (F.col("heads") % F.col("kv_heads") == 0))
    grid = grid.withColumn("inner", F.greatest(F.lit(256), (F.bround(F.col("hidden") * 3 / 256) * 256).cast("long")))
    mlp = F.col("inner") / F.col("hidden")
    shape = F.when(ratio.between(30, 45), 2.0).when(ratio.between(25, 50), 1 + F.least(ratio - 25, 50 - ratio) / 5).when(ratio <= 65, F.greatest(F.lit(0.0), F.least(ratio - 18, 65 - ratio) / 7)).otherwise(-1.0)
    fixed = shape + F.least(F.lit(2.4), 0.4 * (F.col("heads") - 4)) + F.when(mlp.between(2.5, 3.5), 0.5).when(mlp.between(2, 4), 0.0).otherwise(-0.5) + 0.2
    t = F.col("_t")
    wanted = targets.select(F.col(target).alias("_t")).distinct()
    both = wanted.join(F.broadcast(grid.withColumn("_fixed", fixed)), F.lit(True))
    both = both.withColumn("actual", param_count(F.col("hidden"), F.col("layers"), F.col("inner"), F.col("heads"), F.col("kv_heads"), F.lit(head_dim), F.lit(vocab), t < 2_000_000_000))
    away = F.abs(F.col("actual") - t) / t
    both = both.withColumn("_away", F.round(away, 4)).filter(away <= slack).withColumn("score", F.round(F.col("_fixed") + 1 - F.least(away, F.lit(0.3)) / 0.3, 9))
    columns = ["hidden", "layers", "heads", "kv_heads", "inner", "actual", "score"]
    best = both.groupBy("_t").agg(F.min_by(F.struct(*columns), F.struct(-F.col("score"), F.col("_away"), F.col("layers"), F.col("hidden"), F.col("heads"))).alias("shape"))
    return targets.join(best, F.col(target) == F.col("_t"), "left").select(*[targets[c] for c in targets.columns], *[F.col(f"shape.{c}").alias(c) for c in columns])


def vram_gb(params: Column, batch: Column, seq_len: Column, layers: Column, hidden: Column, inner: Column, heads: Column, head_dim: Column) -> Column:
    """Weights, gradients and optimiser at 12 bytes a parameter, and a step's activations."""
    each = hidden * 2 + inner * 4 + heads * head_dim * 2
    return (params * 12 + batch.cast("double") * seq_len * layers * each) / float(1024**3)


def retry_delay(attempt: Column, base: float, most: float) -> Column:
    """The longest wait before an attempt is tried again; the actual one is drawn below it."""
    return F.least(F.lit(most), base * F.pow(F.lit(2.0), attempt - 1))


def retryable(status: Column) -> Column:
    return status.isNull() | (status == 429) | status.between(500, 599)


def matched_peak(names: DataFrame, table: DataFrame, name: str = "gpu") -> DataFrame:
    """Adds tflops of the table's entry (key, tflops) that a device's name is, else of the one that
    shares most words with it, three at least.  The table is a list of devices."""
    split = lambda c: F.array_distinct(F.split(F.lower(c), r"[\s\-_]+"))
    known = table.select(F.col("key"), F.col("tflops"), split(F.col("key")).alias("_k"))
    wanted = names.select(F.col(name).alias("_n")).distinct()
    score = F.when(F.lower("key") == F.lower("_n"), 1_000_000).otherwise(F.size(F.array_intersect(split(F.col("_n")), "_k")))
    best = wanted.join(F.broadcast(known), F.lit(True)).withColumn("_s", score).filter("_s >= 3").groupBy("_n").agg(F.max_by("tflops", F.struct("_s", "key")).alias("tflops"))
    return names.join(best, names[name] == best["_n"], "left").drop("_n")
