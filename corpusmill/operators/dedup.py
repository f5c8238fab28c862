"""Exact, URL, line and near-duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as X

#: So many ids are broadcast.  So many pairs for each row of an index are compared at once.
MOST_IDS, FEW = 1_000_000, 4


def first_of(df: DataFrame, key: Column, order: str) -> DataFrame:
    """One row of each key, the first in order; null keys are one key, rows without a place come
    last.  Rows are aggregated before they are shuffled, so that a key with any share of them is
    no task of its own."""
    place = F.struct(F.col(order).isNull(), F.col(order))
    return df.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*[df[f"`{c}`"] for c in df.columns]), place).alias("_row")).select("_row.*")


def exact(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """The first row of each text, verbatim, by its sha1."""
    return first_of(df, F.sha1(F.col(text).cast("binary")), order)


def unseen(df: DataFrame, seen: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text's sha1 is not in ``seen`` (hash)."""
    return df.withColumn("hash", F.sha1(F.col(text).cast("binary"))).join(seen.select("hash"), "hash", "left_anti").drop("hash")


def with_shingles(df: DataFrame, text: str = "text", n: int = 5, out: str = "shingles") -> DataFrame:
    """Adds the distinct hashes of consecutive, not overlapping, groups of n words.  The words
    are a generated row, so that they are found once and not for each group."""
    w = F.col("_words")
    found = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - n + 1, F.lit(n)), lambda i: F.md5(F.array_join(F.slice(w, i, n), " "))))
    rows = df.select("*", F.explode(F.array(X.words(F.coalesce(F.col(text), F.lit(""))))).alias("_words"))
    return rows.withColumn(out, F.when(F.size(w) < n, F.expr("cast(array() as array<string>)")).otherwise(found)).drop("_words")


def meeting(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b, of sets that meet at a shingle (id, n, at, x) and may be that similar by
    their sizes and by what is left behind the places where they meet."""
    a, b = left.alias("a"), right.alias("b")
    close = (F.col("a.x") == F.col("b.x")) & (F.col("a.id") < F.col("b.id")) & (F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n"))
    # At most the shorter rest can be common, from the first place where the two meet.
    rest = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    pairs = a.join(b, close).groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b")).agg(F.max(rest).alias("most"), F.first(F.col("a.n") + F.col("b.n")).alias("both"))
    return pairs.filter(F.col("most") * (1 + threshold) >= threshold * F.col("both") - 1e-9).select("a", "b")


def near_pairs(df: DataFrame, text: str = "text", order: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """(a, b, jaccard), a < b, of rows whose shingle sets are that similar.

    Texts with one set stand for each other, so copies never meet as pairs here: ``a`` and
    ``b`` are first rows.  Prefix filtering: with shingles ordered by how many sets have them,
    two similar sets share one of their first n - ceil(t n) + 1, so frequent shingles are
    looked up only by sets made of them.  A pair is further bounded by what is left behind the
    places where it meets, before the sets are joined.
    """
    sets = with_shingles(df.select(F.col(order).alias("id"), F.col(text).alias("text")), "text", out="s").select("id", F.sort_array("s").alias("s")).filter("size(s) > 0")
    sets = sets.groupBy("s").agg(F.min("id").alias("id")).select("id", "s", F.size("s").alias("n"))
    flat = sets.select("id", "n", F.explode("s").alias("x"))
    ranked = flat.join(flat.groupBy("x").agg(F.count("*").alias("df")), "x").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("s"))
    prefix = (F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1).cast("int")
    own = ranked.select("id", "n", F.transform("s", lambda p: p["x"]).alias("s"))
    # Shingles of one set alone meet nothing.
    index = ranked.select("id", "n", F.posexplode(F.slice("s", F.lit(1), prefix)).alias("at", "p")).filter("p.df > 1").select("id", "n", "at", F.col("p.x").alias("x"))
    pairs = meeting(index, index, threshold)
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(own.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", (common / (F.size("sa") + F.size("sb") - common)).alias("jaccard")).filter(F.col("jaccard") >= threshold)


def ordered_keep(ids: DataFrame, pairs: DataFrame, checkpoint) -> DataFrame:
    """Rows kept when each is dropped if it is similar to an earlier kept one.

    Rows without a pair are kept at once.  Of the others, one without an earlier undecided
    neighbour is decided; rounds go on until all are, so they follow the longest chain of
    similar rows.  ``checkpoint`` cuts the lineage between rounds.
    """
    edges = checkpoint(pairs.select("a", "b"))
    paired = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    ids = ids.select(F.col(ids.columns[0]).alias("id"))
    state = checkpoint(paired.withColumn("keep", F.lit(None).cast("boolean")))
    while not state.filter("keep is null").isEmpty():
        earlier = edges.join(state.select(F.col("id").alias("a"), "keep"), "a").groupBy("b").agg(F.max(F.coalesce(F.col("keep"), F.lit(False))).alias("dup"), F.max(F.col("keep").isNull()).alias("open"))
        j = state.join(earlier, state.id == earlier.b, "left")
        now = F.when(F.col("keep").isNotNull(), F.col("keep")).when(F.coalesce("dup", F.lit(False)), False).when(~F.coalesce("open", F.lit(False)), True)
        state = checkpoint(j.select("id", now.alias("keep")))
    return ids.join(state.filter("not keep"), "id", "left_anti")


def shingle_sets(df: DataFrame, text: str = "text", order: str = "doc_id", n: int = 5) -> DataFrame:
    """(id, n, h) of each set of shingles, as of ``with_shingles``: its first row, its size and a
    64-bit hash of each shingle.  Texts under n words have none and are told apart by the text.

    The hashes of a set may repeat; they stay, so that what two sets share is never less among
    hashes than among shingles.  Only hashes are shuffled, no text and no shingle.
    """
    w, s = F.col("_words"), F.col("_s")
    rows = df.select(F.col(order).alias("id"), F.sha1(F.col(text).cast("binary")).alias("_text"), F.explode(F.array(X.words(F.coalesce(F.col(text), F.lit(""))))).alias("_words"))
    found = F.sort_array(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - n + 1, F.lit(n)), lambda i: F.array_join(F.slice(w, i, n), " "))))
    rows = rows.select("id", "_text", F.explode(F.array(F.when(F.size(w) < n, F.expr("cast(array() as array<string>)")).otherwise(found))).alias("_s"))
    key = F.unhex(F.when(F.size(s) == 0, F.col("_text")).otherwise(F.sha1(F.array_join(s, "\n").cast("binary"))))
    rows = rows.select("id", key.alias("_key"), F.size(s).alias("n"), F.transform(s, lambda x: F.xxhash64(x)).alias("h"))
    return rows.groupBy("_key", "n").agg(F.min("id").alias("id"), F.first("h").alias("h")).select("id", "n", "h")


def prefix_index(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, n, at, x): the first n - ceil(t n) + 1 hashes of each set (id, n, h), as ordered by
    how many sets have them, without those of one set alone; as in ``near_pairs``.

    One row for each hash is shuffled twice, to count and to join; only those of several sets
    are gathered again.
    """
    flat = sets.select("id", F.explode("h").alias("x"))
    counts = flat.groupBy("x").agg(F.count("*").alias("df")).filter("df > 1")
    shared = flat.join(counts, "x").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("s"))
    prefix, alone = (F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1).cast("int"), F.col("n") - F.size("s")
    ranked = shared.join(sets.select("id", "n"), "id").select("id", "n", alone.alias("alone"), F.when(alone < prefix, F.slice("s", F.lit(1), prefix - alone)).alias("s"))
    return ranked.select("id", "n", "alone", F.posexplode("s").alias("k", "p")).select("id", "n", (F.col("alone") + F.col("k")).alias("at"), F.col("p.x").alias("x"))


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b), whose ids are few or not, of sets (id, n, h) that are that similar."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    own = sets.join(F.broadcast(ids) if ids.count() <= MOST_IDS else ids, "id", "left_semi")
    a, b = (own.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("h").alias(f"h{x}")) for x in "ab")
    common = F.size(F.array_intersect("ha", "hb"))
    return pairs.join(a, "a").join(b, "b").filter(common / (F.col("na") + F.col("nb") - common) >= threshold).select("a", "b")


def greedy_near(sets: DataFrame, checkpoint, threshold: float = 0.8) -> DataFrame:
    """Ids of sets (id, n, h) of which each is dropped if it is similar to an earlier kept one.

    A set that comes first wherever it meets others is kept, and what is similar to it goes;
    rounds of this take a group of near copies by one row for each of them, not for each pair.
    When they no longer pay, all pairs that are left are compared.
    """
    index = checkpoint(prefix_index(sets, threshold))
    decided = dropped = checkpoint(sets.select("id").limit(0))
    before = poor = None
    while True:
        left = index.join(decided, "id", "left_anti")
        keys = left.groupBy("x").agg(F.count("*").alias("m"), F.min("id").alias("lo")).filter("m > 1")
        rows, pairs = keys.agg(F.sum("m"), F.sum(F.col("m") * (F.col("m") - 1) / 2)).first()
        if rows is None or pairs <= FEW * rows or (before and pairs > 0.9 * before and poor):
            break
        poor, before = bool(before and pairs > 0.9 * before), pairs
        met = checkpoint(left.join(keys, "x").select("id", "n", "at", "x", "lo"))
        heads = checkpoint(met.groupBy("id").agg(F.min("lo").alias("lo")).filter("lo = id").select("id"))
        gone = similar(checkpoint(meeting(met.filter("lo = id").join(heads, "id", "left_semi"), met, threshold)), sets, threshold).select(F.col("b").alias("id")).distinct()
        gone = checkpoint(gone)
        dropped, decided = checkpoint(dropped.unionByName(gone)), checkpoint(decided.unionByName(heads).unionByName(gone))
    ids = sets.join(dropped, "id", "left_anti").select("id")
    if rows is None:
        return ids
    return ordered_keep(ids, similar(checkpoint(meeting(left, left, threshold)), sets, threshold), checkpoint)


def line_runs(text: Column) -> Column:
    """Without blank lines, and without a line equal to the one kept before it."""
    lines = F.filter(F.transform(F.split(text, "\n"), X.strip), lambda x: x != "")
    pairs = F.arrays_zip(lines.alias("l"), F.concat(F.array(F.lit(None).cast("string")), lines).alias("p"))
    return F.array_join(F.transform(F.filter(pairs, lambda z: z["l"].isNotNull() & ~z["l"].eqNullSafe(z["p"])), lambda z: z["l"]), "\n")
