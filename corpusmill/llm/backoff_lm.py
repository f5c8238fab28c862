"""Operator 8: stupid-backoff language-model scores, computed relationally.

N-grams of up to ORDER words of every document are exploded, summed per document first, and
counted over the corpus in tables that are partitioned by the n-gram's hash.  Each
document's n-grams are joined to those tables and its scores summed.

A document is scored by the model of all rows but itself: counts leave out its own.  Score of
a word behind its context: the count of both over the context's, if they occur elsewhere;
otherwise BACKOFF times the score behind the context without its first word.  A word that
occurs nowhere else counts UNSEEN times.  A document's first words have the context there is.
The score is the mean natural logarithm over its words; n_backoff is how many of them were not
found behind their whole context.  Nothing is pruned: every n-gram of every row is counted.

To move little, documents are gathered into groups of about GROUP_WORDS words, and what a
group has of n-grams travels packed: one row per bucket of hashes, with the distinct keys in
order and their counts.  A bucket's task is one hash partition of the count tables: it adds
up all rows and joins each of them to the sums key by key; there is a bucket for every
BUCKET_WORDS words or fewer.  A key with any share of the corpus arrives already summed by
group.  The answers join their group, which looks up its own words.

Words are runs of bytes other than the six ASCII blanks, A-Z in lower case; a word or n-gram
is a hash of KEY_BITS bits besides those that choose its bucket; two that agree by chance, some
five in a hundred million, count as one.

Defined results: null text, empty text and text without a word have n_words 0 and a null
score; repeated rows are rows of their own, so that each one's n-grams occur elsewhere; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import groups as text_groups
from corpusmill.llm.common import materialize_bucketed, pick, strings, tidy
from corpusmill.llm.pigeonhole_join import mix, word_hashes

ORDER = 3
BACKOFF = 0.4
UNSEEN = 0.5
#: Words of a group of documents, and of the corpus for each bucket of hashes.
GROUP_WORDS, BUCKET_WORDS = 1 << 20, 1 << 21
#: Bits of a hash besides those that choose its bucket.
KEY_BITS = 44


def _pack(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed; ordered ones by their steps."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def _unpack(packed: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def _pack_keys(k: np.ndarray) -> bytes:
    return _pack(np.diff(k, prepend=np.uint64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, "<u8"), dtype=np.uint64)


def _keys(h: np.ndarray, sizes: np.ndarray, order: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: which words end an n-gram of it, and those n-grams' keys."""
    place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = mix(h, 20)
    for n in range(1, order + 1):
        if n > 1:
            key = mix(np.concatenate([key[:1], key[:-1]]) ^ mix(h, 20 + n), 30)
        inside = place >= n - 1
        yield inside, key[inside] >> np.uint64(max(0, 64 - KEY_BITS - bits))


def gather(docs: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """Groups of documents: group, doc_ids, sizes, the distinct words' hashes and each word's
    place among them."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, found, held = TaskContext.get().partitionId() << 32, [], [], 0

        def flush() -> pa.RecordBatch:
            table, at, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # frequent words get small numbers
            rank = np.empty(len(table), np.int64)
            rank[order] = np.arange(len(table))
            table, at = table[order], rank[at]
            row = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(h) for h in found]], pa.list_(pa.int64())), pa.array([_pack(table)], pa.binary()), pa.array([_pack(at.astype("<u4"))], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["group", "doc_ids", "sizes", "words", "places"])

        for batch in batches:
            at, all_ids = 0, batch.column(0).to_pylist()
            for texts in text_groups(strings(batch.column(1))):
                hashes = word_hashes(texts)
                ids += all_ids[at : at + len(texts)]
                found += hashes
                held += sum(len(h) + 1 for h in hashes)
                at += len(texts)
                if held >= group_words:
                    yield flush()
                    number, ids, found, held = number + 1, [], [], 0
        if ids:
            yield flush()

    docs = pick(docs, "doc_id", "text")
    return docs.select(docs.doc_id.cast("long"), docs.text).mapInArrow(tidy(run), "group long, doc_ids array<long>, sizes array<long>, words binary, places binary")


def _group(words: bytes, places: bytes) -> np.ndarray:
    """The hash of each word of a group."""
    return _unpack(words, "<u8")[_unpack(places, "<u4")]


def count_tables(groups: DataFrame, order: int, bits: int) -> DataFrame:
    """group, n, bucket, counts: for each group's distinct n-grams of a bucket, in order, how
    often the corpus has them outside the group."""
    buckets = 1 << bits

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = np.arange(buckets, dtype=np.uint64) << np.uint64(min(64 - bits, KEY_BITS)) if bits else np.zeros(1, np.uint64)
        for batch in batches:
            for group, sizes, words, places in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                h, sizes = _group(words, places), np.array(sizes, np.int64)
                for n, (_, keys) in enumerate(_keys(h, sizes, order, bits), 1):
                    k, c = np.unique(keys, return_counts=True)
                    cut = np.append(np.searchsorted(k, ends), len(k))
                    some = [b for b in range(buckets) if cut[b] < cut[b + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.int32()), pa.array([group] * len(some), pa.int64()), pa.array([n] * len(some), pa.int32()), pa.array([_pack_keys(k[cut[b] : cut[b + 1]]) for b in some], pa.binary()), pa.array([_pack(c[cut[b] : cut[b + 1]].astype("<u4")) for b in some], pa.binary())],
                        ["bucket", "group", "n", "k", "c"],
                    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(of: tuple[int, int], held: list) -> pa.RecordBatch:
            parts = [_unpack_keys(x[1]) for x in held]
            own = np.concatenate([_unpack(x[2], "<u4") for x in held])
            _, at = np.unique(np.concatenate(parts), return_inverse=True)
            rest = (np.bincount(at, weights=own)[at] - own).astype("<u8")
            ends = np.cumsum([len(x) for x in parts])[:-1]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array([of[1]] * len(held), pa.int32()), pa.array([of[0]] * len(held), pa.int32()), pa.array([_pack(x) for x in np.split(rest, ends)], pa.binary())], ["group", "n", "bucket", "counts"])

        now, held = None, []
        for batch in batches:
            for b, group, n, k, c in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (b, n) != now and held:
                    yield flush(now, held)
                    held = []
                now = (b, n)
                held.append((group, k, c))
        if held:
            yield flush(now, held)

    asked = groups.select("group", "sizes", "words", "places").mapInArrow(tidy(ask), "bucket int, group long, n int, k binary, c binary")
    return asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "n").mapInArrow(tidy(answer), "group long, n int, bucket int, counts binary")


def _elsewhere(keys: np.ndarray, rest: np.ndarray, doc: np.ndarray, some: int = 1 << 17) -> np.ndarray:
    """How often each n-gram occurs outside its document; ``rest``: outside the group, by
    distinct key in order.  ``doc``, in order, numbers the documents."""
    table, c = np.unique(keys, return_counts=True)
    total, out, a = rest.astype(np.int64) + c, np.empty(len(keys), np.int64), 0
    while a < len(keys):  # whole documents at a time
        b = int(np.searchsorted(doc, doc[min(a + some, len(keys)) - 1], side="right"))
        at = np.searchsorted(table, keys[a:b])
        _, pair, own = np.unique((doc[a:b] - doc[a]) * np.int64(len(table)) + at, return_inverse=True, return_counts=True)
        out[a:b] = total[at] - own[pair]
        a = b
    return out


def score(docs: DataFrame, *, order: int = ORDER, backoff: float = BACKOFF, unseen: float = UNSEEN, bits: int | None = None) -> DataFrame:
    """doc_id, n_words, n_backoff, score of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = materialize_bucketed(gather(docs), "groups", "group", partitions)
    total = groups.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    if bits is None:
        bits = (max(partitions, -(-total // BUCKET_WORDS)) - 1).bit_length()
    answers = count_tables(groups, order, bits).groupBy("group").agg(F.collect_list(F.struct("n", "bucket", "counts")).alias("answers"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, words, places, found in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                h, sizes = _group(words, places), np.array(sizes, np.int64)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                value, seen, level = np.zeros(len(h)), np.zeros(len(h), bool), np.zeros(len(h), np.int8)
                context = (total - sizes)[doc].astype(np.float64)  # words outside the document
                for n, (inside, keys) in enumerate(_keys(h, sizes, order, bits), 1):
                    got = [_unpack(x["counts"], "<u8") for x in sorted((x for x in found or [] if x["n"] == n), key=lambda x: x["bucket"])]
                    rest = np.zeros(len(h), np.int64)
                    rest[inside] = _elsewhere(keys, np.concatenate([np.empty(0, "<u8"), *got]), doc[inside])
                    hit = inside & (rest > 0) if n > 1 else inside
                    count = np.maximum(rest, unseen) if n == 1 else rest
                    value[hit] = np.log(count[hit]) - np.log(np.maximum(context[hit], 1))
                    level[hit], seen[inside] = n, hit[inside]
                    context = np.concatenate([[0.0], rest[:-1]])[: len(h)]  # what the next word stands behind
                most = np.minimum(np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1, order)
                value += (most - level) * np.log(backoff)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                sums = [float(value[a:b].sum()) / (b - a) if b > a else None for a, b in zip(ends, ends[1:], strict=False)]
                back = np.concatenate([[0], np.cumsum(~seen)])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), pa.array(np.diff(back[ends]).astype(np.int64)), pa.array(sums, pa.float64())], ["doc_id", "n_words", "n_backoff", "score"])

    return groups.join(answers, "group", "left").select("doc_ids", "sizes", "words", "places", "answers").mapInArrow(tidy(look_up), "doc_id long, n_words long, n_backoff long, score double")


ORACLE = f"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, i, len(ws) AS size, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v, CASE WHEN i > 2 THEN ws[i - 2] END AS u FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
c AS (SELECT *, (SELECT count(*) FROM t) - size AS c0,
        count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY doc_id, w) AS c1,
        CASE WHEN i > 1 THEN count(*) OVER (PARTITION BY v, w) - count(*) OVER (PARTITION BY doc_id, v, w) END AS c2,
        CASE WHEN i > 2 THEN count(*) OVER (PARTITION BY u, v, w) - count(*) OVER (PARTITION BY doc_id, u, v, w) END AS c3 FROM t),
p AS (SELECT *, lag(c1) OVER (PARTITION BY doc_id ORDER BY i) AS p1, lag(c2) OVER (PARTITION BY doc_id ORDER BY i) AS p2 FROM c),
s AS (SELECT doc_id, CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 ELSE 1 END < least(i, 3) AS back,
        CASE WHEN c3 > 0 THEN ln(c3) - ln(p2) WHEN c2 > 0 THEN ln(c2) - ln(p1) ELSE ln(greatest(c1, {UNSEEN})) - ln(greatest(c0, 1)) END
        + (least(i, 3) - CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 ELSE 1 END) * ln({BACKOFF}) AS v FROM p)
SELECT d.doc_id, count(s.doc_id) AS n_words, CAST(coalesce(sum(CAST(back AS INT)), 0) AS BIGINT) AS n_backoff, round(avg(v), 6) AS score
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""
