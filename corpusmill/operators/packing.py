"""Chunking, prefix sums, splits, shards and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunks(df: DataFrame, text: str, most: int, overlap: int = 0) -> DataFrame:
    """Rows per piece (piece_no, piece) of texts longer than ``most`` characters; others whole.
    Pieces begin every most - overlap characters, and end with the first shorter one."""
    step = most - overlap if most > overlap else most
    n = F.length(text)
    # The first piece that is shorter than ``most`` is the last one.
    last = F.when(n <= most, 0).otherwise(F.floor((n - most) / step) + 1)
    starts = F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: i * step)
    starts = F.filter(starts, lambda s: (s < n) | (s == 0))
    out = df.select("*", F.posexplode(starts).alias("piece_no", "_start"))
    return out.withColumn("piece", F.when(F.length(text) <= most, F.col(text)).otherwise(F.col(text).substr(F.col("_start") + 1, F.lit(most)))).drop("_start")


def _ranges(df: DataFrame, order: list[str], parts: int) -> Column:
    """The number of the range that a row's place in the order falls in.  The bounds come from
    one bounded sample and stand in the plan, so that every use of them deals alike."""
    place = F.struct(*[df[f"`{c}`"] for c in order])
    kinds = {c: kind for c, kind in df.dtypes}
    drawn = df.select(place.alias("p")).orderBy(F.rand(1)).limit(20 * parts).orderBy("p").collect()
    cuts = [drawn[i * len(drawn) // parts].p for i in range(1, parts)] if drawn else []
    bounds = [F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, cut, strict=True)]) for cut in dict.fromkeys(cuts)]

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(place < bounds[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))


def running_offset(df: DataFrame, order: list[str], size: Column, parts: int = 64) -> DataFrame:
    """Adds ``offset``: the sum of ``size`` over all rows before, in ``order``.

    Two levels: rows are dealt into ranges of the order, each range sums itself, and the
    ranges' sums, one row each, give where each begins.  No task sees all rows.
    """
    dealt = df.withColumn("_size", size.cast("long")).withColumn("_range", _ranges(df, order, parts))
    sums = dealt.groupBy("_range").agg(F.sum("_size").alias("_sum"))
    before = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumn("_own", F.coalesce(F.sum("_size").over(own), F.lit(0))).join(F.broadcast(before), "_range")  # a row per range
    return out.withColumn("offset", F.col("_before") + F.col("_own")).drop("_range", "_size", "_own", "_before")


def prefix_split(offset: Column, size: Column, budget: Column) -> tuple[Column, Column]:
    """How many of a row's tokens belong to the first ``budget`` ones of the stream, and how
    many come behind."""
    first = F.greatest(F.lit(0), F.least(size, budget - offset))
    return first.cast("long"), (size - first).cast("long")


def every_nth(index: Column, fraction: float) -> Column:
    """Whether a record goes to validation: each period-th one."""
    if fraction <= 0:
        return F.lit(False)
    return index % max(1, round(1 / fraction)) == 0


def rank_of(position: Column, n: Column, world: int) -> Column:
    """Contiguous ranks of n // world rows; the last takes what is over."""
    return F.least(F.floor(position / F.greatest(F.lit(1), F.floor(n / world))), F.lit(world - 1)).cast("int")


def within_budget(df: DataFrame, by: str, order: str, size: Column, budget: int, parts: int = 64) -> DataFrame:
    """Rows written before each group's total reaches its budget; the last may overshoot.

    A group's running total goes over ranges of the order first, so that one group may hold
    any share of the rows.
    """
    dealt = df.withColumn("_size", size.cast("long")).withColumn("_range", _ranges(df, [by, order], parts))
    sums = dealt.groupBy(by, "_range").agg(F.sum("_size").alias("_sum"))
    before = sums.select(F.col(by).alias("_by"), F.col("_range").alias("_r"), (F.sum("_sum").over(Window.partitionBy(by).orderBy("_range")) - F.col("_sum")).alias("_before"))
    own = Window.partitionBy(by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumn("_own", F.coalesce(F.sum("_size").over(own), F.lit(0))).join(before, (F.col(by).eqNullSafe(F.col("_by"))) & (F.col("_range") == F.col("_r")))
    return out.filter(F.col("_before") + F.col("_own") < budget).drop("_size", "_range", "_by", "_r", "_before", "_own")


def assign_shards(df: DataFrame, by: str, order: str, size: Column, most: int, first: dict[str | None, int] | None = None) -> DataFrame:
    """Adds ``shard``: files roll when the next record would overfill one that has any.

    ``first`` has the number that a group's files begin with, where some are there already.
    Rolling is sequential by nature: a group's places and sizes, not its rows, stream through
    one task, batch by batch, and come back by (by, order), which tell rows apart.
    """
    import pandas as pd

    begins = first or {}

    def roll(batches):
        group, shard, held = object(), 0, 0
        for frame in batches:
            out = []
            for g, n in zip(frame["g"].tolist(), frame["n"].tolist(), strict=True):
                if g != group:
                    group, shard, held = g, begins.get(g, 0), 0
                if held and held + n > most:
                    shard, held = shard + 1, 0
                held += n
                out.append(shard)
            yield frame[["g", "o"]].assign(shard=pd.Series(out, dtype="int64", index=frame.index))

    kinds = dict(df.dtypes)
    narrow = df.select(df[by].alias("g"), df[order].alias("o"), size.cast("long").alias("n")).repartition("g").sortWithinPartitions("g", "o")
    numbers = narrow.mapInPandas(roll, f"g {kinds[by]}, o {kinds[order]}, shard long")
    return df.join(numbers, df[by].eqNullSafe(numbers["g"]) & df[order].eqNullSafe(numbers["o"])).drop("g", "o")


def windows(n: Column, length: int, step: int | None = None) -> Column:
    """Starts of the windows of a stream of n tokens that leave room for a shifted target."""
    step = step or length
    return F.when(n > length, F.sequence(F.lit(0).cast("long"), n - length - 1, F.lit(step).cast("long"))).otherwise(F.expr("cast(array() as array<bigint>)"))


def hashed_starts(draw: Column, n: Column, length: int, seed: int) -> Column:
    """A reproducible start in [0, max(1, n - length)) for each draw."""
    return F.pmod(F.xxhash64(draw, F.lit(seed)), F.greatest(F.lit(1), n - length))
