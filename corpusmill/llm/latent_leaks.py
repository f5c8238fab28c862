"""Operator 4: benchmark decontamination by latent semantic retrieval.

1. Words of every document become features (a word's hash among FEATURES); blocks of BLOCK
   words are the passages.  Document frequencies over all passages give the idf weights.
2. Randomised SVD, distributed: with A all passages' normalised TF-IDF rows and W a random
   FEATURES x (RANK + EXTRA) matrix, each task adds its passages' share of (A'A)W; the sum is
   of fixed size whatever the corpus.  The leading eigenpairs follow from it by Nyström's
   formula on the driver.
3. All documents again: overlapping windows and the benchmark's items are projected and
   whitened; windows whose cosine with an item reaches COSINE are candidates.  Window sizes
   double from WINDOW to the longest item, so that each item meets windows of about its own
   length.  Items come in blocks of at most ITEM_BLOCK, a stated query set held against all
   rows.  A text is not held against items of which it lacks more than 1 - PARAPHRASE of the
   words: no window of it could pass the check that follows.
4. A candidate's neighbourhood is checked by words: the longest common subsequence covers
   EXACT of the item, or PARAPHRASE of it while the item's answer (its last ANSWER words)
   is covered to ANSWER_COVER too.

Texts are read in slices of about SLICE characters that overlap by more than any window, so
that memory does not follow a text's length.

Words are lower-cased, split at white space, and stripped of punctuation at both ends.

Defined results: null and empty texts, on either side, and items without a word match
nothing; repeated rows give repeated results; empty tables give an empty table; other
columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import pick, strings, tidy

FEATURES = 1 << 15
BLOCK = 32
RANK, EXTRA = 64, 8
COSINE = 0.2
#: The smallest window; each next one is twice as long, up to the longest item.  A window is
#: for the items up to its size and an eighth, so that none is much longer than its items.
WINDOW = 16
#: Words of windows that are projected at a time, and characters that are split into words.
WORDS_AT_ONCE, SLICE = 1 << 14, 1 << 18
ITEM_BLOCK = 4096
EXACT = 0.8
PARAPHRASE = 0.6
ANSWER, ANSWER_COVER = 8, 0.75
#: Share of an item's words, the rarest ones, that are counted before all are.
RARE = 0.6
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…–—¿¡|"
#: Windows begin at multiples of so many words.
STEP = 8
#: Passages that the latent basis is fitted on: all, unless a caller sets a bound and so has rows
#: sampled, each by itself, copies too.  Frequencies and the search cover all rows anyway.
FIT_PASSAGES: int | None = None
#: Passages that the fit takes at a time.
FIT_AT_ONCE = 1 << 13
#: Slices in which sums over features are passed on.
SLICES = 16


def _classes() -> np.ndarray:
    """By code point: 1 white space, 2 punctuation, 0 anything else."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    out[[i for i in range(0x3001) if chr(i).isspace()]] = 1
    out[[ord(c) for c in _PUNCTUATION]] = 2
    return out


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of code points, powers of an odd base, and of its inverse, modulo 2**64."""
    base, n = 0x9E3779B97F4A7C15, 2 * SLICE

    def powers(x: int) -> np.ndarray:
        out, step = np.ones(n, np.uint64), 1
        while step < n:
            more = min(step, n - step)
            out[step : step + more] = out[:more] * np.uint64(pow(x, step, 1 << 64))
            step += more
        return out

    return _classes(), powers(base), powers(pow(base, -1, 1 << 64))


class Words(NamedTuple):
    """The words of lower-case text: features (FEATURES for punctuation alone), and where each
    begins and ends without punctuation around it."""

    text: str
    feature: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def bare(self, a: int, b: int) -> list[str]:
        return [self.text[x:y] for x, y in zip(self.begin[a:b].tolist(), self.end[a:b].tolist(), strict=True) if x < y]


def words_of(text: str) -> Words:
    """A word's feature is a hash of its characters: differences of running sums over the
    text, each character times a power that its place gives."""
    classes, power, inverse = _tables()
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    if n > len(power):
        raise ValueError("longer than a slice")
    kind = classes[code]
    solid = np.concatenate([[False], kind != 1, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    begin, end = edges[::2], edges[1::2]
    ragged = np.flatnonzero((kind[begin] == 2) | (kind[end - 1] == 2)) if n else begin
    if len(ragged):
        begin, end = begin.copy(), end.copy()
        inner = np.flatnonzero(kind == 0)
        first = np.searchsorted(inner, begin[ragged])
        last = np.searchsorted(inner, end[ragged])
        some = first < last
        at = ragged[some]
        begin[at], end[at] = inner[first[some]], inner[last[some] - 1] + 1
        end[ragged[~some]] = begin[ragged[~some]]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((code + np.uint64(1)) * power[:n], out=sums[1:])
    h = (sums[end] - sums[begin]) * inverse[begin] if n else np.empty(0, np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    feature = (h >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.uint16)
    feature[begin == end] = FEATURES
    return Words(text, feature, begin, end)


def slices(text: str, overlap: int = 0) -> Iterator[str]:
    """A long text in parts of SLICE characters or more, each from ``overlap`` words before
    the end of the last."""
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        while end < len(text) and end < at + 2 * SLICE and not text[end].isspace():
            end += 1
        part = text[at:end]
        yield part
        kept = part.rsplit(None, overlap) if overlap and end < len(text) else []
        at = at + len(kept[0]) if len(kept) > overlap and kept[0] else end


def read(texts: Iterator[str | None], overlap: int = 0) -> Iterator[tuple[Words, list[tuple[int, int, int]]]]:
    """Texts in lower case, many short ones or a part of a long one at a time, with each text's
    number and the range of its words."""

    def group(numbers: list[int], parts: list[str]) -> tuple[Words, list[tuple[int, int, int]]]:
        words = words_of("\n".join(parts))
        ends = np.searchsorted(words.begin, np.cumsum([len(p) + 1 for p in parts]))
        return words, list(zip(numbers, [0, *ends[:-1].tolist()], ends.tolist(), strict=True))

    numbers, held, size = [], [], 0
    for i, t in enumerate(texts):
        t = (t or "").lower()
        if len(t) > SLICE:
            for part in slices(t, overlap):
                yield group([i], [part])
            continue
        numbers.append(i)
        held.append(t)
        size += len(t) + 1
        if size > SLICE - 64:
            for part in ((numbers[:-1], held[:-1]), (numbers[-1:], held[-1:])) if size > 2 * SLICE else ((numbers, held),):
                yield group(*part)
            numbers, held, size = [], [], 0
    if held:
        yield group(numbers, held)


def _added(partial: DataFrame, dtype: str) -> np.ndarray:
    """The sum of packed arrays by slice, added up in two steps; SLICES rows reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(packed.as_buffer(), dtype)
                sums[s] = sums[s] + x if s in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "sum"])

    schema = "slice int, sum binary"
    rows = partial.repartition(SLICES, "slice").mapInArrow(tidy(add), schema).collect()
    return {r.slice: np.frombuffer(r.sum, dtype) for r in rows}


def _slices(x: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One by one: the executor holds a batch outside its heap."""
    for i, s in enumerate(np.split(x, SLICES)):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([s.tobytes()], pa.binary())], ["slice", "sum"])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Passages as rows of BLOCK features, padded with FEATURES, those of some texts at a time."""
    for batch in batches:
        for words, ranges in read(strings(batch.column(0))):
            solid = words.feature < FEATURES
            upto = np.concatenate([[0], np.cumsum(solid)])
            size = np.array([upto[b] - upto[a] for _, a, b in ranges])
            pad = -size % BLOCK
            out = np.full(int(size.sum() + pad.sum()), FEATURES, np.uint16)
            f = words.feature[solid]
            out[np.arange(len(f)) + np.repeat(np.cumsum(pad) - pad, size)] = f
            if len(out):
                yield out.reshape(-1, BLOCK)


class Basis(NamedTuple):
    """What each feature adds to a text's whitened latent vector, and its idf weight."""

    vectors: np.ndarray
    idf: np.ndarray


def fit(docs: DataFrame, rank: int = RANK, seed: int = 1) -> Basis:
    """The latent basis of a corpus; without a passage, one that finds nothing alike."""
    nothing = Basis(np.zeros((FEATURES, 1), np.float32), np.zeros(FEATURES, np.float32))
    docs = pick(docs, "text").filter("text is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(FEATURES + SLICES, np.int64)  # the last slice's end: the number of passages
        for rows in _passages(batches):
            rows = np.sort(rows, axis=1)
            first = np.ones(rows.shape, bool)
            first[:, 1:] = rows[:, 1:] != rows[:, :-1]
            df[:FEATURES] += np.bincount(rows[first], minlength=FEATURES + 1)[:FEATURES]
            df[-1] += len(rows)
        yield from _slices(df)

    df = _added(docs.mapInArrow(tidy(frequencies), "slice int, sum binary"), "<i8")
    if not df:
        return nothing
    df = np.concatenate([df[i] for i in range(SLICES)])
    df, n = df[:FEATURES], int(df[-1])
    if not n:
        return nothing
    idf = np.where(df > 0, np.log((1 + n) / (1 + df)) + 1e-3, 0).astype(np.float32)
    idf = np.append(idf, np.float32(0))
    size = rank + EXTRA

    def matrix() -> np.ndarray:
        return np.random.default_rng(seed).standard_normal((FEATURES + 1, size)).astype(np.float32)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A passage's row of A is its features' idf over its norm, so idf is multiplied in by
        # feature, before the first sum and behind the second one.
        omega, total = matrix() * idf[:, None], np.zeros((size, FEATURES + 1))

        def add(rows: np.ndarray) -> None:
            y = np.empty((size, len(rows)))
            for i in range(0, len(rows), 128):
                part = rows[i : i + 128]
                w = idf[part]
                y[:, i : i + 128] = (omega[part].sum(axis=1) / np.maximum(np.einsum("pb,pb->p", w, w), 1e-18)[:, None]).T
            feature = rows.reshape(-1).astype(np.intp)
            for c in range(size):
                total[c] += np.bincount(feature, np.repeat(y[c], BLOCK), FEATURES + 1)

        held: list[np.ndarray] = []
        for rows in _passages(batches):
            held.append(rows)
            if sum(map(len, held)) >= FIT_AT_ONCE:
                add(np.concatenate(held))
                held = []
        if held:
            add(np.concatenate(held))
        yield from _slices((total * idf).T[:FEATURES].astype(np.float32).reshape(-1))

    if FIT_PASSAGES and FIT_PASSAGES < n:
        docs = docs.sample(FIT_PASSAGES / n, seed=seed)
    # A task's partial sum has a fixed size, so few tasks sum it, each over several parts of the rows.
    z = _added(docs.coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(tidy(share), "slice int, sum binary"), "<f4")
    z = np.concatenate([z[i] for i in range(SLICES)]).reshape(FEATURES, size).astype(np.float64)
    # Nyström: A'A is about Z (W'Z)^-1 Z'.
    core = matrix()[:FEATURES].astype(np.float64).T @ z
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > max(value.max(), 0) * 1e-6
    if not good.any():
        return nothing
    root = z @ (vector[:, good] / np.sqrt(value[good]))
    u, s, _ = np.linalg.svd(root, full_matrices=False)
    keep = s[:rank] > s[0] * 1e-4
    return Basis((idf[:FEATURES, None] * u[:, :rank][:, keep] / s[:rank][keep]).astype(np.float32), idf[:FEATURES])


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, one machine word per step for short ``a``."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if m := where.get(x):
            u = v & m
            v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), FEATURES, np.uint16)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out


class Items:
    """Benchmark items, prepared to be searched for."""

    def __init__(self, rows: list[tuple[int, str]], basis: Basis):
        table = basis.vectors
        self.ids, self.words, features = [], [], []
        for i, text in rows:
            found = words_of(text.lower()) if len(text) < SLICE else None
            parts = [found] if found else [words_of(x) for x in slices(text.lower())]
            w = [x for part in parts for x in part.bare(0, len(part.begin))]
            if w:
                self.ids.append(i)
                self.words.append(w)
                features.append(np.concatenate([p.feature[p.feature < FEATURES] for p in parts]))
        self.table = np.concatenate([table, np.zeros((1, table.shape[1]), np.float32)])  # for FEATURES
        n = np.array([len(w) for w in self.words])
        q = np.array([table[f].sum(axis=0) for f in features], np.float32).reshape(len(self.ids), table.shape[1])
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)
        self.least = PARAPHRASE * n
        # Of an item's RARE rarest words, this many are covered if PARAPHRASE of all are.
        rare = [f[np.argsort(-basis.idf[f], kind="stable")[: math.ceil(RARE * len(f))]] for f in features]
        self.least_rare = self.least - (n - np.array([len(x) for x in rare]))
        # By window: its size, the items, their vectors, and their features, all and rare ones,
        # for bounds on how much of an item a stretch of text can cover.
        self.sets = []
        low, size = 0, WINDOW
        while low < n.max(initial=0):
            high = size + size // 8
            at = np.flatnonzero((n > low) & (n <= high))
            if len(at):
                self.sets.append((size, at, np.ascontiguousarray(q[at].T), _padded([features[k] for k in at]), _padded([rare[k] for k in at])))
            low, size = high, 2 * size
        self.overlap = 3 * self.sets[-1][0] if self.sets else 0
        if self.overlap * 16 > SLICE:
            raise ValueError("an item is too long for slices of this size")
        self.here = np.zeros(FEATURES + 1, bool)

    def search(self, texts: Iterator[str | None]) -> Iterator[tuple[int, int, float, float, float]]:
        """Number of the text, item, cosine, cover of the item, cover of its answer, of each leak."""
        now, out = -1, {}
        for words, ranges in read(texts, self.overlap):
            for i, a, b in ranges:
                if i != now:
                    yield from ((now, self.ids[k], *out[k]) for k in sorted(out))
                    now, out = i, {}
                if self.sets and b - a >= self.least.min():
                    self._search(words, a, b, out)
        yield from ((now, self.ids[k], *out[k]) for k in sorted(out))

    def _search(self, words: Words, a: int, b: int, out: dict[int, tuple]) -> None:
        """Windows begin at the first word and every quarter of their size from there; each is
        held against the items whose rare words its neighbourhood has."""
        f, here = words.feature[a:b], self.here
        here[f] = True
        here[FEATURES] = False
        possible = []
        for _, at, _, own, rare in self.sets:
            some = np.flatnonzero(here[rare].sum(axis=1) >= self.least_rare[at])
            possible.append(some[here[own[some]].sum(axis=1) >= self.least[at[some]]] if len(some) else some)
        here[f] = False
        for (size, at, q, own, rare), some in zip(self.sets, possible, strict=True):
            if not len(some):
                continue
            begin = np.arange(0, len(f), max(1, size // 4 // STEP) * STEP)
            low, high = np.maximum(begin - size, 0), np.minimum(begin + 2 * size, len(f))
            enough = np.empty((len(begin), len(some)), bool)
            for c, j in enumerate(some.tolist()):
                here[rare[j]] = True
                here[FEATURES] = False
                where = np.flatnonzero(here[f])
                here[rare[j]] = False
                enough[:, c] = np.searchsorted(where, high) - np.searchsorted(where, low) >= self.least_rare[at[j]]
            live = np.flatnonzero(enough.any(axis=1))
            q, many = q[:, some], max(1, WORDS_AT_ONCE // size)
            for first in range(0, len(live), many):
                part = live[first : first + many]
                place = begin[part][:, None] + np.arange(size)
                v = self.table[np.where(place < len(f), f[np.minimum(place, len(f) - 1)], FEATURES)].sum(axis=1)
                v /= np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-9)[:, None]
                cosine = v @ q
                for r, c in np.argwhere((cosine >= COSINE) & enough[part]).tolist():
                    j, w = int(some[c]), part[r]
                    k = int(at[j])
                    if k in out:
                        continue
                    near = f[low[w] : high[w]]
                    here[near] = True
                    here[FEATURES] = False
                    can = here[own[j]].sum() >= self.least[k]
                    here[near] = False
                    if can and (covers := self._covers(k, words.bare(a + int(low[w]), a + int(high[w])))):
                        out[k] = (float(cosine[r, c]), *covers)

    def _covers(self, k: int, region: list[str]) -> tuple[float, float] | None:
        """How much of an item, and of its answer, a stretch of words has in order, if enough."""
        own = self.words[k]
        cover = common_length(own, region) / len(own)
        answer = own[-ANSWER:]
        told = common_length(answer, region) / len(answer)
        return (cover, told) if cover >= EXACT or (cover >= PARAPHRASE and told >= ANSWER_COVER) else None


def leaks(docs: DataFrame, benchmark: DataFrame, *, basis: Basis | None = None) -> DataFrame:
    """doc_id, item_id, cosine, cover, answer_cover of every benchmark item found in a document."""
    docs, items = pick(docs, "doc_id", "text"), pick(benchmark, "item_id", "text").filter("text is not null")
    if basis is None:
        basis = fit(docs)
    schema = "doc_id long, item_id long, cosine double, cover double, answer_cover double"
    blocks = -(-items.count() // ITEM_BLOCK)
    out = docs.sparkSession.createDataFrame([], schema)
    for k in range(blocks):
        rows = [(r.item_id, r.text) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]

        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            wanted = Items(rows, basis)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = [(ids[i], *x) for i, *x in wanted.search(strings(batch.column(1)))]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 2 else pa.float64()) for i, c in enumerate(columns)], ["doc_id", "item_id", "cosine", "cover", "answer_cover"])

        part = docs.select(docs.doc_id.cast("long"), docs.text).mapInArrow(tidy(run), schema)
        out = part if blocks == 1 else out.unionByName(part)
    return out
