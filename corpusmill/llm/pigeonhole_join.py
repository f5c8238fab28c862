"""Operator 6: exact Jaccard join over sets of word shingles by universe partitioning.

Texts with one set of shingles are one node.  The sizes of sets fall into bands.  A band's
scheme hashes the universe of shingles into m segments; each node indexes, per segment, its
subset there, and for the first d segments also every subset with one element deleted.  A
node that is larger probes the scheme of the band below too, where a partner may lie.

Pigeonhole: two linked sets differ in at most H elements (the sizes and the threshold tell).
A segment probed by its exact subset catches a pair that agrees there and counts one; one
probed with deletions catches a difference of one and counts two.  If the counts exceed H,
a linked pair meets in some segment.  m + d = H + 1 + slack, so each node may leave out
probes worth ``slack``, a deletion or an exact probe behind the first d segments at one each:
by cost, first what is empty, then those whose subset most others have.

1. Every text gets its node and size; each node, histograms of its set.
2. Keys and nodes are dealt into buckets of keys, packed, as many as the sets call for; a
   bucket yields the keys that several nodes share.
3. In ROUNDS rounds, each node is held against one hub of its keys.  Linked ones form
   components, so that near copies never expand into all pairs.
4. Keys in which several components are left are dealt out in blocks of BLOCK indexed nodes,
   past which the probing ones stream, those that one node leads to one task, which tells of
   a pair once; pairs of different components that sizes, sketches and histograms don't
   exclude are verified exactly.

A histogram counts a set's elements by hash in bins of about PER_BIN, a sketch has one bit for
each of smaller bins, whether the count is odd; the distance of two is at most the difference
of the sets.  A shingle is a 64-bit hash, a node the 64-bit hash of
its set, which a second one guards against collisions; verification compares the sets
themselves: those of one component are held together, HELD shingles at a time, and a set is
sent to each such part once, however many pairs it has there.  Sets are not stored, which would
take more room than the texts, but hashed again from the texts that stand for their nodes.

Defined results: null text, empty text and text without a word have no shingles, no link and
are their own component; fewer than five words make one shingle; repeated rows and texts are
linked; rows of one doc_id are rows of their own; rows without doc_id take part in links but
name no component; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import groups, materialize, pick, strings, tidy
from corpusmill.llm.graph import components

WORDS = 5
PERCENT = 80
BAND = 1.5
SLACK = 0.15
#: Elements in a bin of a histogram, its fewest bins and a sketch's most bits as powers of two.
PER_BIN, LEAST_BITS, MOST_BITS = 4, 6, 11
#: Ids up to this many are broadcast (16 MB); beyond it the join is shuffled.
BROADCAST_IDS = 1_000_000
#: Shingles of the sets that are held together, and sets that are sent past them at a time.
HELD, GROUP = 1 << 21, 512
#: Indexed nodes of a key that are held together.
BLOCK = 2048
#: Rows of keys with one lead that stay together, and pairs that a task holds before it tells of them.
LEAD_ROWS, MET_PAIRS = 1 << 15, 1 << 20
#: What a node is to a key: those that are indexed are sorted before the guests.
INDEXED, BOTH, GUEST = 0, 1, 2
#: Rounds that hold nodes against one hub each, before all pairs left are.
ROUNDS = 2
#: Shingles that a bucket of keys gets, and keys that are packed at a time.
BUCKET_SHINGLES, PACKED_KEYS = 1 << 20, 1 << 19
_MASK = (1 << 64) - 1


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser, by the constants of splitmix64."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & _MASK)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Bytes that are split into words at a time; words longer than LONG_WORD are hashed alone.
PIECE, LONG_WORD = 1 << 16, 1 << 12
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base, and of its inverse, modulo 2**64."""
    base, n = 0x9E3779B97F4A7C15, 2 * PIECE
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-case bytes, and where each begins.

    A word's hash is the difference of two running sums, each byte times a power that its
    place gives, brought to the word's beginning."""
    power, inverse = _powers()
    n = len(data)
    if n > len(power):  # one word is that long
        words = data.split()
        alone = [xxhash.xxh64_intdigest(w) if len(w) > LONG_WORD else int(_hashed(w)[0][0]) for w in words]
        return np.array(alone, np.uint64), np.zeros(len(words), np.int64)
    code = np.frombuffer(data, np.uint8)
    solid = np.zeros(n + 2, bool)
    np.logical_not(_BLANK[code], out=solid[1:-1])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    begin, end = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((code + np.uint64(1)) * power[:n], out=sums[1:])
    h = mix((sums[end] - sums[begin]) * inverse[np.minimum(begin, max(n - 1, 0))])
    for i in np.flatnonzero(end - begin > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(data[begin[i] : end[i]])
    return h, begin


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of each text's words; bytes lower-case only A-Z and split at exactly the six blanks."""
    out: list[np.ndarray] = []
    held, size = [], 0

    def flush() -> None:
        h, begin = _hashed(b"\n".join(held))
        ends = np.searchsorted(begin, np.cumsum([len(d) + 1 for d in held]))
        out.extend(np.split(h, ends[:-1]))

    for t in texts:
        data = (t or "").encode("utf-8", "surrogatepass").lower()
        if size and size + len(data) > PIECE:
            flush()
            held, size = [], 0
        if len(data) <= PIECE:
            held.append(data)
            size += len(data) + 1
            continue
        parts, at = [], 0
        while at < len(data):
            end = min(at + PIECE, len(data))
            while end < len(data) and not _BLANK[data[end]]:
                end += 1
            parts.append(_hashed(data[at:end])[0])
            at = end
        out.append(np.concatenate(parts))
    if held:
        flush()
    return out


def shingles(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of n-word shingles."""
    words = word_hashes(texts)
    h = np.concatenate([np.empty(0, np.uint64), *words])
    rolled = np.zeros(len(h), np.uint64)
    factor = 1
    for i in range(min(n, len(h))):  # a polynomial of the words' hashes, odd base
        rolled[: len(h) - i] += h[i:] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 & _MASK
    rolled = mix(rolled, n)
    out, at = [], 0
    for ws in words:
        k = len(ws)
        if k >= n:
            one = np.sort(rolled[at : at + k - n + 1])
            out.append(one[np.concatenate([[True], one[1:] != one[:-1]])])
        elif k:  # the whole sequence as one
            x = np.uint64(k)
            for w in ws:
                x = mix(np.array([x ^ w]), k)[0]
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += k
    return out


def most_different(r: int, s: int, percent: int = PERCENT) -> int:
    """The largest symmetric difference of linked sets of these sizes (-1: never linked)."""
    common = -(-percent * (r + s) // (100 + percent))
    return r + s - 2 * common if common <= min(r, s) else -1


def _most_different(r: np.ndarray, s: np.ndarray, percent: int) -> np.ndarray:
    common = -(-percent * (r + s) // (100 + percent))
    return np.where(common <= np.minimum(r, s), r + s - 2 * common, -1)


@lru_cache(maxsize=None)
def bands(upto: int, percent: int = PERCENT) -> list[tuple[int, int, int, int, int]]:
    """(lowest size, highest size, m, d, slack) of each band, up to one that holds ``upto``."""
    out, low = [], 1
    while not out or out[-1][1] < upto:
        high = max(low, int(low * BAND))
        h = max(most_different(r, s, percent) for s in {high, max(low, high - 1)} for r in range(max(s, 100 * s // percent - 2), 100 * s // percent + 1))
        slack = max(2, int(np.ceil(SLACK * (h + 1)))) if h > 0 else 0
        slack = min(slack, h + 1)
        out.append((low, high, h + 1, slack, slack))
        low = high + 1
    return out


@lru_cache(maxsize=1 << 16)
def schemes(n: int, percent: int = PERCENT) -> list[tuple[int, bool]]:
    """(band, whether only as a prober) that a set of n elements uses."""
    found = bands(1 << max(8, n.bit_length()), percent)
    own = next(i for i, b in enumerate(found) if n <= b[1])
    out = [(own, False)] if found[own][2] > 1 else []
    below = own - 1
    while below >= 0 and found[below][1] * 100 >= percent * n:
        if found[below][2] > 1:
            out.append((below, True))
        below -= 1
    return out


PROBE_ONLY, DROPPABLE, PROBES = 1, 2, 4
_LEFT = 8  # from this bit on: probes that the node may still leave out


def ordered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set's elements by their place in the universe (32 bits), and what stands for each."""
    place = mix(h, 11) >> np.uint64(32)
    order = np.argsort(place)
    return place[order], mix(h[order], 12)


def signatures(place: np.ndarray, value: np.ndarray, band: int, scheme: tuple[int, int, int, int, int], probe_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of an ordered set in a scheme, and their flags; a segment is a stretch of places."""
    _, _, m, d, slack = scheme
    seg = (place * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(m, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    sums[seg[first]] = np.add.reduceat(value, first)
    place = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32), 13)
    flags = np.full(m, PROBES, np.int64)
    flags[d:] |= DROPPABLE
    count = np.bincount(seg, minlength=m)
    k = int(np.searchsorted(seg, d))  # elements of segments with deletions
    deleted = mix((sums[seg[:k]] - value[:k]) ^ place[seg[:k]], 14)
    flags2 = np.full(k, PROBES | DROPPABLE, np.int64)
    # What the node leaves out for certain, as most others have it: empty subsets, at one
    # probe each, or two where deletions would have found a difference of one as well.
    left = slack
    drop = np.flatnonzero((count == 0) & (np.arange(m) >= d))[:left]
    flags[drop] &= ~PROBES
    left -= len(drop)
    drop = np.flatnonzero(count[seg[:k]] == 1)[:left]
    flags2[drop] = 0
    left -= len(drop)
    drop = np.flatnonzero(count[:d] == 0)[: left // 2]
    flags[drop] &= ~PROBES
    left -= 2 * len(drop)
    keys = np.concatenate([mix(sums ^ place, 14), deleted])
    return keys, np.concatenate([flags, flags2]) | (PROBE_ONLY if probe_only else 0) | left << _LEFT


def bits_of(n: int) -> int:
    return max(LEAST_BITS, (-(-n // PER_BIN) - 1).bit_length())


def histogram(h: np.ndarray) -> np.ndarray:
    """Elements by bin; 255 stands for any number from there on."""
    bits = bits_of(len(h))
    return np.minimum(np.bincount((mix(h, 15) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def sketch(h: np.ndarray) -> np.ndarray:
    """A bit for each bin, whether its number of elements is odd, packed: eight bins for one of
    the histogram's, up to 1 << MOST_BITS."""
    bits = min(MOST_BITS, bits_of(len(h)) + 3)
    return np.packbits(np.bincount((mix(h, 15) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8) & 1)


def flipped(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Bits in which each row differs from one other, which has as many or more: an element
    flips one, so it is a lower bound on the difference of the sets."""
    if len(one) > sketches.shape[1]:
        one = np.packbits(np.bitwise_xor.reduce(np.unpackbits(one).reshape(8 * sketches.shape[1], -1), axis=1))
    return np.bitwise_count(sketches ^ one).sum(axis=1, dtype=np.int64)


def _folded(hist: np.ndarray, bins: int) -> np.ndarray:
    """Rows of histograms with neighbouring bins added up to ``bins``."""
    wide = hist.astype(np.int32)
    return wide if hist.shape[1] == bins else wide.reshape(len(hist), bins, -1).sum(axis=2)


def distance(hist: np.ndarray, one: np.ndarray) -> np.ndarray:
    """A lower bound on the difference of each row's set and one other; 0 where bins are full."""
    bins = min(hist.shape[1], len(one))
    out = np.abs(_folded(hist, bins) - _folded(one[None, :], bins)).sum(axis=1)
    full = (hist == 255).any(axis=1) | (one == 255).any()
    return np.where(full, 0, out)


def node_of(h: np.ndarray, seed: int) -> int:
    x = int(mix(h, 16 + seed).sum(dtype=np.uint64)) ^ len(h)
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (null without shingles) and guard of every row; the
    histograms only with the first row of each node that a task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            at = 0
            for texts in groups(strings(batch.column(2))):
                sets = shingles(texts, n)
                node = [node_of(h, seed) if len(h) else None for h in sets]
                guard = [node_of(h, 99) for h in sets]
                if len(met) > 1 << 18:
                    met.clear()
                hists, rough = [], []
                for x, h in zip(node, sets, strict=True):
                    new = x is not None and x not in met
                    if new:
                        met.add(x)
                    hists.append(histogram(h).tobytes() if new else None)
                    rough.append(sketch(h).tobytes() if new else None)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(at, len(texts)) for i in (0, 1)), pa.array([len(h) for h in sets], pa.int64()), pa.array(node, pa.int64()), pa.array(guard, pa.int64()), pa.array(hists, pa.binary()), pa.array(rough, pa.binary())],
                    ["doc_id", "text_hash", "n_shingles", "node", "guard", "hist", "coarse"],
                )
                at += len(texts)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(tidy(run), "doc_id long, text_hash long, n_shingles long, node long, guard long, hist binary, coarse binary")


def shared_keys(docs: DataFrame, n: int, percent: int, seed: int, buckets: int) -> DataFrame:
    """key, node, flags, others: of every key that several nodes have and one probes.

    A key travels as the 40 bits behind those that choose its bucket; keys that agree in them
    by chance meet for nothing."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, nodes, left = [], 0, [], []
        met: set[int] = set()  # copies within a task are indexed once

        def flush() -> pa.RecordBatch:
            k, f = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            who = np.repeat(np.arange(len(held), dtype=np.uint16), [len(x[0]) for x in held])
            at = ((k >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(at, kind="stable")
            k = np.ascontiguousarray(k[order].view(np.uint8).reshape(-1, 8)[:, :5])
            f, who = f[order], who[order]
            ends = np.searchsorted(at[order], np.arange(buckets + 1))
            found = np.flatnonzero(ends[:-1] < ends[1:]).tolist()
            own, room = np.array(nodes, np.int64), np.array(left, np.int32)
            rows: list[list[bytes]] = [[], [], [], [], []]
            for b in found:
                part = slice(ends[b], ends[b + 1])
                w = who[part]  # in order
                first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                count = np.diff(np.append(first, len(w))).astype(np.int32)
                for column, x in zip(rows, (k[part], f[part], count, own[w[first]], room[w[first]]), strict=True):
                    column.append(x.tobytes())
            return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *[pa.array(r, pa.binary()) for r in rows]], ["bucket", "k", "f", "count", "nodes", "room"])

        for batch in batches:
            for texts in groups(strings(batch.column(0))):
                for h in shingles(texts, n):
                    if not len(h) or (node := node_of(h, seed)) in met:
                        continue
                    if len(met) > 1 << 18:
                        met.clear()
                    met.add(node)
                    place, value = ordered(h)
                    found = bands(1 << max(8, len(h).bit_length()), percent)
                    for band, probe_only in schemes(len(h), percent):
                        k, f = signatures(place, value, band, found[band], probe_only)
                        held.append((k, (f & ((1 << _LEFT) - 1)).astype(np.uint8)))
                        nodes.append(node)
                        left.append(int(f[0]) >> _LEFT)
                        size += len(k)
                    if size >= PACKED_KEYS or len(held) > 60_000:
                        yield flush()
                        held, size, nodes, left = [], 0, [], []
        if held:
            yield flush()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(bucket: int, rows: list) -> pa.RecordBatch:
            raw = np.frombuffer(b"".join(r[0] for r in rows), np.uint8).reshape(-1, 5)
            k = np.full((len(raw), 8), 0, np.uint8)
            k[:, :5] = raw
            k = k.view(np.uint64).reshape(-1)
            order = np.argsort(k)
            k = k[order]
            some = np.ones(len(k), bool)  # keys that occur twice at all; the others go at once
            some[1:-1] = (k[1:-1] == k[:-2]) | (k[1:-1] == k[2:])
            k, order = k[some], order[some]
            counts = np.cumsum(np.frombuffer(b"".join(r[2] for r in rows), np.int32), dtype=np.int64)
            at = np.searchsorted(counts, order, side="right")
            v = np.frombuffer(b"".join(r[3] for r in rows), np.int64)[at]
            f = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)[order].astype(np.int32)
            f |= np.frombuffer(b"".join(r[4] for r in rows), np.int32)[at] << _LEFT
            order = np.lexsort((v, k))
            k, v, f = k[order], v[order], f[order]
            first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])])[: len(k)])  # copies from other tasks
            f = np.bitwise_or.reduceat(f & PROBES, first) | (f[first] & ~PROBES) if len(first) else f
            # A key met both ways by one node probes and indexes; its own flags agree otherwise.
            k, v = k[first], v[first]
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])[: len(k)])
            size = np.diff(np.append(start, len(k)))
            keep = np.zeros(len(k), bool)
            if len(k):
                index = np.logical_or.reduceat((f & PROBE_ONLY) == 0, start)
                keep = np.repeat((size > 1) & index & np.logical_or.reduceat((f & PROBES) > 0, start), size)
            key = mix(k[keep] ^ np.uint64(bucket << 40), 17).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(v[keep]), pa.array(f[keep]), pa.array(np.repeat(size, size)[keep].astype(np.int64))], ["key", "node", "flags", "others"])

        now, rows = None, []
        for batch in batches:
            for b, *x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != now and rows:
                    yield flush(now, rows)
                    rows = []
                now = b
                rows.append(x)
        if rows:
            yield flush(now, rows)

    packed = docs.select("text").mapInArrow(tidy(pack), "bucket int, k binary, f binary, count binary, nodes binary, room binary")
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(unpack), "key long, node long, flags int, others long")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, percent: int, seed: int) -> DataFrame:
    """Links (a, b) among node pairs (a, b, g), where g is the component of b: one for each a
    and part of g that has any.

    The sets of a component's nodes b are held together in parts of HELD shingles; an a is
    sent to each part that it has pairs in, and the part to one task for every GROUP of them.
    """
    own = nodes.select("node", "rep", "text_hash", "n")
    hosts = pairs.select("g", F.col("b").alias("node")).distinct().join(own, "node")
    room = hosts.groupBy("g").agg(F.ceil(F.sum("n") / HELD).cast("int").alias("parts"))
    hosts = materialize(hosts.join(room, "g").select("g", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node", "rep", "text_hash"), "hosts")
    guests = pairs.join(hosts.select("g", F.col("node").alias("b"), "part"), ["g", "b"]).groupBy(F.col("a").alias("node"), "g", "part").agg(F.collect_list("b").alias("bs"))
    guests = materialize(guests.join(own, "node").select("g", "part", "node", "rep", "text_hash", "bs"), "guests")
    many = guests.groupBy("g", "part").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("salts"))
    sent = guests.join(many, ["g", "part"]).select("g", "part", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("guest"), "node", "bs", "rep", "text_hash")
    kept = hosts.join(many, ["g", "part"]).select("g", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("guest"), "node", F.lit(None).cast("array<long>").alias("bs"), "rep", "text_hash")
    meets = materialize(sent.unionByName(kept), "meets")
    size = meets.agg((4 * F.count("*") + F.coalesce(F.sum(F.size("bs")), F.lit(0))).alias("x")).first().x
    if size <= BROADCAST_IDS:
        meets = F.broadcast(meets)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple] = set()  # rows that agree in doc_id and text send their set once a task
        for batch in batches:
            at = 0
            ids = list(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True))
            for texts in groups(strings(batch.column(6))):
                here = ids[at : at + len(texts)]
                new = [i for i, x in enumerate(here) if x not in done and not done.add(x)]
                own_sets = shingles([texts[i] for i in new], n)
                keep = [(i, h) for i, h in zip(new, own_sets, strict=True) if len(h) and node_of(h, seed) == here[i][3]]
                places = pa.array([at + i for i, _ in keep], pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(places) for i in range(6)), pa.array([h.tobytes() for _, h in keep], pa.binary())], ["g", "part", "salt", "guest", "node", "bs", "h"])
                at += len(texts)
            if len(done) > 1 << 18:
                done.clear()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            a, b = [], []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for *of, guest, node, wanted, h in zip(*columns, batch.column(5), batch.column(6), strict=True):
                h = np.frombuffer(h.as_buffer(), np.uint64)
                if of != now:
                    now, held = of, {}
                if not guest:
                    held[node] = h.copy()
                    continue
                for x in wanted.as_py():
                    other = held[x]
                    small, large = (h, other) if len(h) < len(other) else (other, h)
                    common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                    if 100 * common >= percent * (len(h) + len(other) - common):
                        a.append(node)
                        b.append(x)
                        break  # all of g are one component already
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("text_hash"), "text").alias("d").join(meets.alias("m"), (F.col("d.text_hash") == F.col("m.text_hash")) & F.col("d.rep").eqNullSafe(F.col("m.rep")))
    schema = "g long, part int, salt int, guest boolean, node long, bs array<long>, "
    sent = rows.select("g", "part", "salt", "guest", "node", "bs", "text").mapInArrow(tidy(sets), schema + "h binary")
    return materialize(sent.repartition(tasks, "g", "part", "salt").sortWithinPartitions("g", "part", "salt", "guest").mapInArrow(tidy(linked), "a long, b long"), "links")


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, g) that sizes and histograms do not exclude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = _most_different(batch.column(5).to_numpy(), batch.column(6).to_numpy(), percent)
            keep = []
            for x, y, m in zip(batch.column(3), batch.column(4), most.tolist(), strict=True):
                x, y = (np.frombuffer(h.as_buffer(), np.uint8) for h in (x, y))
                keep.append(m >= 0 and distance(x[None, :], y)[0] <= m)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(3)], ["a", "b", "g"])

    rows = pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("hist").alias("x")), "a").join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("hist").alias("y")), "b")
    return materialize(rows.select("a", "b", "g", "x", "y", "na", "nb").mapInArrow(tidy(run), "a long, b long, g long"), "possible")


def _probing(shared: DataFrame) -> DataFrame:
    """key, node, probes, indexes, w: each node leaves out those of its probes that most others
    have, as far as its slack goes; w is how much it shares."""
    droppable = F.col("flags").bitwiseAND(DROPPABLE + PROBES) == DROPPABLE + PROBES
    scheme = [F.col("node"), F.col("flags").bitwiseAND(PROBE_ONLY), F.shiftright("flags", _LEFT)]
    rank = F.row_number().over(Window.partitionBy(*scheme, droppable).orderBy(F.desc("others"), "key"))
    dropped = droppable & (rank <= F.shiftright("flags", _LEFT))
    probes = (F.col("flags").bitwiseAND(PROBES) > 0) & ~dropped
    indexes = F.col("flags").bitwiseAND(PROBE_ONLY) == 0
    rows = shared.select("key", "node", probes.alias("probes"), indexes.alias("indexes"), F.sum("others").over(Window.partitionBy("node")).alias("w"))
    return rows.filter("probes or indexes")


def _meeting(rows: DataFrame, roots: DataFrame | None, salt: int) -> DataFrame:
    """Rows of the keys that are probed, and in which components meet, with the node's component
    (root) and the key's hub: at first the node that shares most, later any one by hash."""
    rows = rows.select("key", "node", "probes", "indexes", "w")
    if roots is None:
        rows = rows.withColumn("root", F.col("node"))
    else:
        rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.xxhash64("node", F.lit(salt)), "node") if salt else F.struct("w", "node")
    of = rows.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.max("probes").alias("probed"), F.max("indexes").alias("indexed"), F.count("*").alias("many"), F.max_by(F.struct("node", "root"), order).alias("hub"))
    return rows.join(of.filter("r1 <> r2 and probed and indexed").select("key", "many", "hub"), "key")


def _stars(met: DataFrame) -> DataFrame:
    """(a, b, g): for each node, the hub b of most of its keys that is of another component g."""
    met = met.filter("root <> hub.root").groupBy("node", F.col("hub.node").alias("b"), F.col("hub.root").alias("g")).agg(F.count("*").alias("c"))
    return met.groupBy(F.col("node").alias("a")).agg(F.max_by(F.struct("b", "g"), F.struct("c", "b")).alias("best")).select("a", "best.b", "best.g")


def _met(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, g) of different components that meet in a key which the larger one, a,
    probes and b indexes, as far as sizes and sketches allow; some more than once.

    Like texts meet in most of their keys, so keys go where their lead does, the node that
    shares most, and a pair is told of once there."""
    busy = rows.groupBy("lead").count().filter(F.col("count") > LEAD_ROWS).select("lead", F.ceil(F.col("count") / LEAD_ROWS).alias("salts"))
    rows = rows.join(F.broadcast(busy), "lead", "left").withColumn("lead", F.when(F.col("salts").isNull(), F.col("lead")).otherwise(F.xxhash64("lead", F.pmod("key", "salts"))))
    rows = rows.filter("probes or indexes").withColumn("parts", F.ceil(F.col("many") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # A key in one part gets each node once; in several, an indexed one goes to its own part, a probing one to all.
    places = F.expr(f"""CASE WHEN parts = 1 THEN array(struct(0 AS part, CASE WHEN NOT probes THEN {INDEXED} WHEN indexes THEN {BOTH} ELSE {GUEST} END AS kind))
        ELSE concat(filter(array(struct(own AS part, {INDEXED} AS kind)), x -> indexes), filter(transform(sequence(0, parts - 1), p -> struct(p AS part, {GUEST} AS kind)), x -> probes)) END""")
    placed = rows.select("lead", "key", F.explode(places).alias("at"), "node", "root", "n", "coarse").select("lead", "at.part", "key", "at.kind", "node", "root", "n", "coarse")

    def once(found: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
        if not found:
            return []
        a, b, g = (np.concatenate([x[i] for x in found]) for i in range(3))
        order = np.lexsort((b, a))
        a, b, g = a[order], b[order], g[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        return [(a[new], b[new], g[new])]

    def sent(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64)) for i in range(3)], ["a", "b", "g"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, now, held, guests, ready = None, None, [], [], None
        done, found, size = [], [], 0  # pairs of groups that are through, and of this one

        def visit(node: int, root: int, n: int, own: bytes) -> int:
            some, one = 0, np.frombuffer(own, np.uint8)
            for nodes, roots, sizes, sketches in ready:
                at = np.flatnonzero(((sizes < n) | ((sizes == n) & (nodes < node))) & (roots != root) & (100 * sizes >= percent * n))
                if len(at):
                    at = at[flipped(sketches[at], one) <= _most_different(np.int64(n), sizes[at], percent)]
                if len(at):
                    found.append((np.full(len(at), node, np.int64), nodes[at], roots[at]))
                some += len(at)
            return some

        def seated() -> int:
            """Makes ready for guests, by the length of sketches; those that are indexed as well come first."""
            nonlocal ready
            alike: dict[int, list] = {}
            for x in held:
                alike.setdefault(len(x[3]), []).append(x)
            ready = [(*(np.array([x[i] for x in xs], np.int64) for i in range(3)), np.frombuffer(b"".join(x[3] for x in xs), np.uint8).reshape(len(xs), -1)) for xs in alike.values()]
            return sum(visit(*x) for x in guests)

        for batch in batches:
            for lead, part, key, kind, *x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lead, part, key) != now:
                    if guests and ready is None:
                        size += seated()
                    if (lead, part) != group:
                        done += once(found)
                        found.clear()
                        group, size = (lead, part), 0
                    now, held, guests, ready = (lead, part, key), [], [], None
                if kind != GUEST:
                    held.append(x)
                    if kind == BOTH:
                        guests.append(x)
                    continue
                if ready is None:
                    size += seated()
                size += visit(*x)
                if size > MET_PAIRS:
                    found[:] = once(found)
                    size = sum(len(y[0]) for y in found)
                    if size > MET_PAIRS // 2:
                        yield sent(found)
                        found.clear()
                        size = 0
            if done:
                yield sent(done)
                done = []
        if guests and ready is None:
            seated()
        yield sent(done + once(found))

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(tasks, "lead", "part").sortWithinPartitions("lead", "part", "key", "kind").mapInArrow(tidy(meet), "a long, b long, g long")


def link(docs: DataFrame, *, n: int = WORDS, percent: int = PERCENT, buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text")
    docs = docs.select(docs.doc_id.cast("long").alias("doc_id"), docs.text)
    for seed in range(8):
        prints = materialize(fingerprints(docs, n, seed), "prints")
        by_node = prints.filter("node is not null").groupBy("node").agg(F.min_by("doc_id", F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))).alias("rep"), F.max("n_shingles").alias("n"), F.min("n_shingles").alias("n2"), F.min("guard").alias("g1"), F.max("guard").alias("g2"), F.min_by("text_hash", F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))).alias("text_hash"), F.max("hist").alias("hist"), F.max("coarse").alias("coarse"))
        nodes = materialize(by_node, "nodes")
        told = nodes.agg(F.count(F.when(F.expr("n <> n2 or g1 <> g2"), 1)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("shingles")).first()
        if not told.bad:
            break
    else:
        raise ValueError("every seed has colliding sets")
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-told.shingles // BUCKET_SHINGLES))
    left = materialize(_probing(shared_keys(docs, n, percent, seed, buckets)), "shared")

    links, roots = spark.createDataFrame([], "a long, b long"), None
    for k in range(ROUNDS):
        left = materialize(_meeting(left, roots, k), "left")
        links = links.unionByName(_verified(_possible(_stars(left), nodes, percent), nodes, docs, n, percent, seed))
        roots = materialize(components(links), "roots")

    # What meets in a probed key and is not yet together.
    rows = _meeting(left, roots, 0).join(nodes.select("node", "n", "coarse"), "node").select("key", "many", F.col("hub.node").alias("lead"), "node", "root", "n", "coarse", "probes", "indexes")
    more = _possible(_met(materialize(rows, "rows"), percent).distinct(), nodes, percent)
    together = components(links.unionByName(_verified(more, nodes, docs, n, percent, seed)))

    groups_ = nodes.select("node", "rep").join(together, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = groups_.groupBy("root").agg(F.min("rep").alias("component"))
    named = groups_.join(least, "root").select("node", "component")
    # A row without doc_id is nobody's smallest one; alone it has no component.
    return prints.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS x FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = d.doc_id
"""
