"""Packed token streams: pairs to records, records to splits and places, windows, random access.

A packed folder holds the blocks of a stream as rows (split, start, ids, mask), written by
Spark's committer to any store, and a manifest (split, records, tokens, masked, dtype).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import packing, tokens
from corpusmill.sources import token_files

#: Tokens of a stretch of the stream that windows and pieces are matched by.
STRETCH = 1 << 16


def code_points(text: Column) -> Column:
    """A text as ids, one a character: a tokenizer that needs no file."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def records(df: DataFrame, given: Column, learnt: Column, most: int, end_id: int = 0) -> DataFrame:
    """Adds ids and mask of each pair of token arrays cut to ``most``; too short ones go."""
    d = df.withColumn("_g", given).withColumn("_l", learnt)
    cut = tokens.fitted(F.col("_g"), F.col("_l"), most)
    d = d.withColumn("_p", cut[0]).withColumn("_a", cut[1]).filter(tokens.long_enough(F.col("_p"), F.col("_a")))
    return d.withColumn("_r", tokens.record(F.col("_p"), F.col("_a"), end_id)).withColumn("ids", F.col("_r.ids")).withColumn("mask", F.col("_r.mask")).drop("_g", "_l", "_p", "_a", "_r")


def laid_out(recs: DataFrame, order: list[str], val_fraction: float, parts: int = 64) -> DataFrame:
    """Adds split (each period-th kept record is for validation) and start, the record's place
    in its split's stream."""
    numbered = packing.running_offset(recs, order, F.lit(1), parts).withColumnRenamed("offset", "number")
    numbered = numbered.withColumn("split", F.when(packing.every_nth(F.col("number"), val_fraction), "val").otherwise("train"))
    placed = [packing.running_offset(numbered.filter(F.col("split") == s), order, F.size("ids"), parts) for s in ("train", "val")]
    return placed[0].unionByName(placed[1]).withColumnRenamed("offset", "start")


def manifest(laid: DataFrame, vocab_size: int) -> DataFrame:
    """Records, tokens and tokens under the mask by split."""
    under = F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x)
    return laid.groupBy("split").agg(F.count("*").alias("records"), F.sum(F.size("ids")).cast("long").alias("tokens"), F.sum(under).alias("masked")).withColumn("dtype", F.lit(token_files.dtype_for(vocab_size)))


def write(laid: DataFrame, folder: str, vocab_size: int) -> None:
    laid.select("split", "start", "ids", "mask").write.partitionBy("split").parquet(f"{folder}/blocks")
    manifest(laid, vocab_size).coalesce(1).write.json(f"{folder}/manifest")


def kind_of(spark: SparkSession, folder: str) -> str:
    """``pairs`` for a folder with blocks and manifest, ``stream`` for one with meta.json."""
    fs = spark._jvm.org.apache.hadoop.fs
    there = lambda name: (p := fs.Path(f"{folder}/{name}")).getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    if there("meta.json"):
        return "stream"
    if there("manifest") and there("blocks"):
        return "pairs"
    raise ValueError(f"no packed data in {folder}")


def read(spark: SparkSession, folders: list[str], split: str) -> DataFrame:
    """One stream (start, ids, mask) of several packed folders, in their order; those whose
    manifest lacks the split are left out."""
    out, before = None, 0
    for folder in folders:
        told = spark.read.json(f"{folder}/manifest").filter(F.col("split") == split).select("tokens").first()
        if told is None:
            continue
        rows = spark.read.parquet(f"{folder}/blocks").filter(F.col("split") == split).select((F.col("start") + before).alias("start"), "ids", "mask")
        out, before = rows if out is None else out.unionByName(rows), before + told.tokens
    if out is None:
        raise ValueError(f"no {split} split")
    return out


def at(stream: DataFrame, wanted: DataFrame) -> DataFrame:
    """(start, length) rows of ``wanted`` with the ids and mask that stand there.

    Pieces and windows are joined by the stretches of the stream that they touch, a piece's part
    of a window is cut before anything is gathered, and a window gathers its own length.
    """
    touched = lambda a, b: F.explode(F.sequence(F.floor(a / STRETCH), F.floor((F.greatest(b, a + 1) - 1) / STRETCH)))
    pieces = stream.withColumn("_end", F.col("start") + F.size("ids")).withColumnRenamed("start", "_start")
    pieces = pieces.withColumn("_at", touched(F.col("_start"), F.col("_end")))
    windows = wanted.withColumn("_at", touched(F.col("start"), F.col("start") + F.col("length")))
    both = windows.join(pieces, "_at").filter((F.col("_start") < F.col("start") + F.col("length")) & (F.col("_end") > F.col("start")) & (F.col("_at") == F.floor(F.greatest("_start", "start") / STRETCH)))
    low = F.greatest(F.col("start") - F.col("_start"), F.lit(0))
    high = F.least(F.col("_end"), F.col("start") + F.col("length")) - F.col("_start")
    cut = lambda c: F.slice(c, (low + 1).cast("int"), (high - low).cast("int"))
    parts = both.groupBy("start", "length").agg(F.sort_array(F.collect_list(F.struct("_start", cut("ids").alias("ids"), cut("mask").alias("mask")))).alias("p"))
    return parts.select("start", "length", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.flatten(F.transform("p", lambda x: x["mask"])).alias("mask"))


def training_windows(stream: DataFrame, length: int) -> DataFrame:
    """start, ids, targets, mask of the (n - 1) // length aligned windows; targets and their mask
    stand one further."""
    n = stream.agg(F.max(F.col("start") + F.size("ids"))).first()[0] or 0
    starts = stream.sparkSession.range(0, max(0, (n - 1) // length)).select((F.col("id") * length).alias("start"), F.lit(length + 1).alias("length"))
    w = at(stream, starts)
    return w.select("start", F.slice("ids", 1, length).alias("ids"), F.slice("ids", 2, length).alias("targets"), F.slice("mask", 2, length).alias("mask"))


def example_ids(stream: DataFrame, most: int) -> DataFrame:
    """The first ``most`` tokens with their mask, as a viewer shows them."""
    return at(stream, stream.sparkSession.createDataFrame([(0, most)], "start long, length int"))


def tokens_of(stream: DataFrame) -> DataFrame:
    """pos, token, mask: the stream as rows, from which boundaries are found again."""
    return stream.select("start", F.posexplode(F.arrays_zip("ids", "mask")).alias("i", "x")).select((F.col("start") + F.col("i")).alias("pos"), F.col("x.ids").alias("token"), F.col("x.mask").alias("mask"))
