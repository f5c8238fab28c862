"""Approximate duplicate filters: a Bloom filter and MinHash bands, and the chain of both kinds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import dedup

BLOOM_HASHES = 4
#: Bands and rows that MinHash signatures of 128 values are dealt into, for a threshold of 0.8.
BANDS, ROWS = 9, 13


def bloom_bits(text: Column, size_bytes: int, hashes: int = BLOOM_HASHES) -> Column:
    """The bits of a text: little-endian 32-bit slices of the sha256 of its sha1, modulo the bits."""
    digest = F.sha2(F.unhex(F.sha1(text.cast("binary"))), 256)
    number = lambda i: F.conv(F.concat(*[F.substring(digest, 8 * i + 2 * k + 1, 2) for k in (3, 2, 1, 0)]), 16, 10).cast("long")
    return F.array(*[number(i) % max(8, 8 * size_bytes) for i in range(hashes)])


def bloom_unseen(df: DataFrame, size_bytes: int, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Rows that a Bloom filter of this size, filled in order, has not seen: those for one of
    whose bits no earlier row set it.  A row is never kept twice; false hits drop new ones.

    A bit is first set by the least row that has it, whether that row is kept or not, as a row
    that is dropped has all its bits set before it; so one aggregation by bit tells everything.
    """
    kept = dedup.exact(df.filter(F.col(text).isNotNull()), text, order)
    bits = kept.select(F.col(order).alias("id"), F.explode(F.array_distinct(bloom_bits(F.col(text), size_bytes))).alias("bit"))
    first = bits.groupBy("bit").agg(F.min("id").alias("id")).select("id").distinct()
    return kept.join(first, kept[order] == first["id"], "left_semi")


def minhashes(shingles: Column, n: int = BANDS * ROWS) -> Column:
    """The least of each of n hash functions over a set of shingles."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(seed))))

    return F.array(*[least(i) for i in range(n)])


def lsh_pairs(df: DataFrame, text: str = "text", order: str = "doc_id", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(a, b), a < b, of rows that share a band of MinHash values with the first one of the band.
    Sets are not compared.  Texts under five words have no shingles and meet nothing.

    Only the first row of a band's bucket stands in pairs, so a bucket of any size gives as many
    pairs as it has rows.
    """
    sets = dedup.with_shingles(df.select(F.col(order).alias("id"), F.col(text).alias("text")), "text", out="s").filter("size(s) > 0")
    sets = sets.groupBy(F.sort_array("s").alias("s")).agg(F.min("id").alias("id"))
    signed = sets.select("id", F.explode(F.array(minhashes(F.col("s"), bands * rows))).alias("h"))
    band = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(*[F.get("h", F.lit(b * rows + r)) for r in range(rows)]).alias("key")) for b in range(bands)])).alias("b")
    placed = signed.select("id", band).select("id", "b.band", "b.key")
    first = placed.groupBy("band", "key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1")
    return placed.join(first, ["band", "key"]).filter("a < id").select("a", F.col("id").alias("b")).distinct()


def near_dedup(method: str = "exact") -> Callable[[DataFrame], DataFrame]:
    """The pairs that a method calls near duplicates: ``exact`` sets, or ``minhash`` bands."""
    return {"exact": lambda df: dedup.near_pairs(df).select("a", "b"), "minhash": lsh_pairs}[method]


def chained(df: DataFrame, checkpoint, method: str = "exact", text: str = "text", order: str = "doc_id") -> DataFrame:
    """Rows left by exact, then by near duplicates: an exact copy of a row that was dropped as a
    near duplicate is an exact duplicate still."""
    return dedup.exact(df.join(chained_ids(df, checkpoint, method, text, order), order, "left_semi"), text, order)


def chained_ids(df: DataFrame, checkpoint, method: str = "exact", text: str = "text", order: str = "doc_id") -> DataFrame:
    """The ids of ``chained``.  No text is shuffled, only the hashes of its shingles."""
    sets = checkpoint(dedup.shingle_sets(df, text, order).filter("id is not null"))
    short, sets = sets.filter("n = 0").select(F.col("id").alias(order)), sets.filter("n > 0")
    kept = dedup.greedy_near(sets, checkpoint) if method == "exact" else dedup.ordered_keep(sets.select("id"), near_dedup(method)(df.select(order, text)), checkpoint)
    return kept.select(F.col("id").alias(order)).unionByName(short)
