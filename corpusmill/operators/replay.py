"""Which parts of a stream training has drawn, and what is left of it for annealing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import intervals, packed


def drawn(steps: DataFrame, n: int, length: int, seed: int, workers: int = 0) -> DataFrame:
    """rank, start, stop of the windows that a run's draws took.

    ``steps`` has (rank, calls).  Without workers a loader draws once ahead of its calls; with
    them the calls are split evenly, the first ones taking what is over, and each draws by a
    seed of its own.  Draws are hashes of seed, rank, worker and number.
    """
    if workers <= 0:
        draws = steps.select("rank", F.lit(0).alias("worker"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("calls"))).alias("i"))
    else:
        each = steps.select("rank", "calls", F.explode(F.sequence(F.lit(0), F.lit(workers - 1))).alias("worker"))
        own = F.floor(F.col("calls") / workers) + (F.col("worker") < F.col("calls") % workers).cast("long")
        draws = each.withColumn("own", own).filter("own > 0").select("rank", "worker", F.explode(F.sequence(F.lit(0).cast("long"), F.col("own") - 1)).alias("i"))
    start = F.pmod(F.xxhash64("i", "worker", "rank", F.lit(seed)), F.lit(max(1, n - length)))
    return draws.select("rank", start.alias("start"), (start + length).alias("stop"))


def unused(windows: DataFrame, shards: DataFrame, least: int) -> DataFrame:
    """rank, start, stop of gaps of at least ``least`` tokens that no window touched; ``shards``
    has (rank, n)."""
    sized = windows.join(shards, "rank")
    gaps = intervals.invert(intervals.merge(sized, "rank", "n"), "rank", "n", shards)
    return gaps.filter(F.col("stop") - F.col("start") >= least)


def anneal(stream: DataFrame, gaps: DataFrame) -> DataFrame:
    """start, ids, mask: the gaps' tokens, one gap behind the other by rank and place.  ``gaps``
    has places in the whole stream."""
    from corpusmill.operators import packing

    wanted = gaps.select("start", (F.col("stop") - F.col("start")).alias("length"))
    found = packed.at(stream, wanted)
    placed = packing.running_offset(found, ["start"], F.col("length"))
    return placed.select(F.col("offset").alias("start"), "ids", "mask")
