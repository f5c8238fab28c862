"""Half-open intervals per group: merging, inverting, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge(df: DataFrame, by: str, upto: str | None = None) -> DataFrame:
    """Merges touching and overlapping (start, stop) rows of each group, clipped to [0, upto)."""
    d = df.select(by, *([upto] if upto else []), F.greatest(F.col("start"), F.lit(0)).alias("start"), (F.least("stop", upto) if upto else F.col("stop")).alias("stop")).filter("stop > start")
    order = Window.partitionBy(by).orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    d = d.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(by, *([upto] if upto else []), "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def invert(merged: DataFrame, by: str, upto: str, groups: DataFrame) -> DataFrame:
    """What merged intervals leave of [0, upto); ``groups`` has (by, upto), also of those
    without an interval."""
    ends = groups.select(by, upto, F.col(upto).alias("start"), F.col(upto).alias("stop"))
    order = Window.partitionBy(by).orderBy("start", "stop")
    rows = merged.select(by, upto, "start", "stop").unionByName(ends)
    gaps = rows.select(by, upto, F.coalesce(F.lag("stop").over(order), F.lit(0)).cast("long").alias("start"), F.col("start").cast("long").alias("stop"))
    return gaps.filter("stop > start")


def coverage(gaps: DataFrame, by: str, upto: str, groups: DataFrame, least: int) -> DataFrame:
    """Unused tokens in gaps of at least ``least``, and the rest."""
    kept = gaps.filter(F.col("stop") - F.col("start") >= least).groupBy(by).agg(F.sum(F.col("stop") - F.col("start")).alias("unused"), F.count("*").alias("runs"))
    g = groups.select(by, upto).join(kept, by, "left").select(by, upto, F.coalesce("unused", F.lit(0)).cast("long").alias("unused"), F.coalesce("runs", F.lit(0)).cast("long").alias("runs"))
    return g.withColumn("used", F.col(upto) - F.col("unused"))
