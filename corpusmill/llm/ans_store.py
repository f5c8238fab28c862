"""Operator 3: token ids written as entropy-coded blocks, and read back.

Ids of documents in ascending doc_id order, each document closed by an end id, are cut
into blocks.  One frequency table of the whole corpus serves all blocks.  A block is coded
by LANES interleaved range asymmetric numeral systems with 64-bit states that shift 32
bits at a time: id number i belongs to lane i mod LANES.  Every STEPS rounds a checkpoint
holds all states and the place in the word stream, so any segment decodes by itself; every
segment has a checksum.  Blocks are rows of a Parquet table, so that Spark's committer and
any store that Spark writes to handle them; the frequency table lies beside it.

Layout of a block (little-endian): header ``<4sIIII`` (magic, ids, lanes, segments,
words); per segment u32 crc32 of its ids, u32 place of its first word, u64 states[lanes];
then u32 words.  The row adds bucket, block, start (ids of the corpus before the block)
and its directory: doc_ids, the number of ids of each that lie in the block, and where in
the corpus the first one of them begins.

Defined results: null and empty texts have the end id alone; an empty table gives empty
files; documents of one doc_id follow each other, ordered by their ids, each with a row of
its own; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm.bpe_codec import to_chars
from corpusmill.llm.common import PieceEncoder, groups, materialize, new_path, pick, strings, tidy

MAGIC = b"RNS1"
LANES = 256
STEPS = 256  # rounds between checkpoints: 65,536 ids
BLOCK_IDS = LANES * STEPS * 4
SIDE = 8  # blocks that a worker codes side by side
SCALE_BITS = 19  # the table's frequencies sum to 2**19
LOW = np.uint64(1 << 31)  # states stay in [2**31, 2**63)
_HEADER = struct.Struct("<4sIIII")


# ---- encoding texts -------------------------------------------------------------------


SPACE_CHAR, LINE_CHAR = to_chars(b" "), to_chars(b"\n")
#: Units that a worker remembers; with half of them encoding takes a quarter longer.
REMEMBERED = 1 << 19
#: Longer units, in characters, are not: they hardly come again.
LONGEST = 64
#: Bytes of text that are encoded at a time, or one longer text.
GROUP_BYTES = 4 << 20

# Classes of bytes.  HIGH is any byte of a character beyond ASCII; APART cuts nothing.
_APART, _SPACE, _LINE, _LETTER, _DIGIT, _MARK, _HIGH = range(7)
_CLASS = np.full(256, _APART, np.uint8)
_CLASS[[i for i in range(0x21, 0x7F) if chr(i) != "'"]] = _MARK  # an apostrophe takes letters behind it
for _chars, _kind in ((range(0x30, 0x3A), _DIGIT), ([*range(0x41, 0x5B), *range(0x61, 0x7B)], _LETTER), ([0x20], _SPACE), ([0x0A], _LINE), (range(0x80, 0x100), _HIGH)):
    _CLASS[list(_chars)] = _kind
#: First bytes of two-byte characters that are letters all: U+00C0 to U+02BF, but for two
#: signs, and U+0400 to U+047F.
_LETTER_LEAD = np.isin(np.arange(256), [*range(0xC3, 0xCB), 0xD0, 0xD1])
_SIGNS = np.array([0x97, 0xB7], np.uint8)  # of C3: multiplication and division
_BEFORE_LINE = np.isin(np.arange(8), [_LETTER, _DIGIT, _MARK])
_CUT = np.zeros(64, bool)
_CUT[[8 * x + y for x, y in ((_LETTER, _MARK), (_DIGIT, _MARK), (_MARK, _LETTER), (_MARK, _DIGIT), (_LETTER, _DIGIT), (_DIGIT, _LETTER))]] = True
_CUT[[8 * x + _SPACE for x in (_LETTER, _DIGIT, _MARK, _HIGH)]] = True


def unit_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where UTF-8 texts, back to back in ``data`` and beginning at ``rows``, can be cut so
    that byte-level splitting gives each unit the tokens it has in its text.

    A match is letters, digits or marks with at most one space before them, an apostrophe
    with letters, or white space, which alone looks at what follows.  So a match ends where
    letters, digits and marks change, and where white space begins; no cut is made behind
    white space but for a single line break, which is a match of its own.
    """
    cls = _CLASS[data]
    high = np.flatnonzero(cls == _HIGH)
    high = high[high > 0]
    before = data[high - 1]
    cls[high[_LETTER_LEAD[before] & ~((before == 0xC3) & np.isin(data[high], _SIGNS))]] = _LETTER  # the last byte of a letter
    pair = cls[:-1] * np.uint8(8) + cls[1:]
    cut = np.zeros(len(data), bool)
    cut[1:] = _CUT[pair]
    at = np.flatnonzero(pair == 8 * _HIGH + _SPACE)  # white space beyond ASCII, or what may be
    one, two = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    blank = (one == 0xC2) | ((two == 0xE2) & ((one == 0x80) | (one == 0x81))) | ((two == 0xE3) & (one == 0x80)) | ((two == 0xE1) & ((one == 0x9A) | (one == 0xA0)))
    cut[at[blank] + 1] = False
    at = np.flatnonzero(pair[1:] == 8 * _LINE + _LETTER) + 1
    at = at[_BEFORE_LINE[cls[at - 1]]]
    cut[at] = cut[at + 1] = True
    cut[rows[rows < len(data)]] = True
    return np.flatnonzero(cut)


class LibraryEncoder:
    """Ids of texts as the tokenizers library gives them without added special tokens, each
    text closed by an end id.

    Where the file has byte-level splitting and no normaliser, texts are cut into units, the
    distinct units of many texts are found by Arrow, and only those not remembered are
    encoded; a unit that is a single match goes straight to the library's model, byte-mapped
    as its splitter would.  Texts with a special string in them, and all texts of other
    files, are not cut this way.
    """

    def __init__(self, path: str, width: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.width = Tokenizer.from_file(path), width
        self.end = np.array([end_id], width).tobytes()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"] or {}
        self.direct = spec["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces = None if self.direct else PieceEncoder(self._texts, self._texts, lambda t: any(s in t for s in self.special), REMEMBERED)

    def _matches(self, matches: list[str]) -> list[bytes]:
        """Of letters, with or without a space before them."""
        run, code = self.tokenizer.model.tokenize, "H" if self.width == "<u2" else "I"
        # ASCII letters stand for themselves; the others are mapped all at once.
        other = iter(to_chars("\n".join(m for m in matches if not m.isascii()).encode()).split(LINE_CHAR))
        chars = [(SPACE_CHAR + m[1:] if m[0] == " " else m) if m.isascii() else next(other) for m in matches]
        return [array(code, [t.id for t in run(c)]).tobytes() for c in chars]

    def _texts(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.width == "<u2" else "I"
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units, remembered or not."""
        if len(self.young) > REMEMBERED:  # what wasn't met for long is forgotten
            self.young, self.old = {}, self.young
        ids = list(map(self.young.get, units))
        words, rest = [], []
        for i in compress(range(len(units)), map(is_, ids, repeat(None))):
            u = units[i]
            if (found := self.old.get(u)) is not None:
                ids[i] = self.young[u] = found
            else:
                (words if (u[1:] if u[0] == " " else u).isalpha() else rest).append(i)
        for places, encode in ((words, self._matches), (rest, self._texts)):
            new = [units[i] for i in places]
            for i, u, found in zip(places, new, encode(new) if new else [], strict=True):
                ids[i] = found
                if len(u) <= LONGEST:
                    self.young[u] = found
        return ids

    def _cut(self, texts: pa.Array) -> pa.Array:
        """The packed ids of a few texts."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        if first == last:
            return pa.array([self.end] * len(texts), pa.binary())
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[first:last]
        offsets = offsets - first
        starts = unit_starts(data, offsets[:-1])
        for found in (m.start() for s in self.special for m in re.finditer(re.escape(s.encode()), data)):
            row = int(np.searchsorted(offsets, found, "right")) - 1
            starts = starts[(starts <= offsets[row]) | (starts >= offsets[row + 1])]
        places = pa.py_buffer(np.append(starts, last - first) + first)
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, places, held]).dictionary_encode()
        units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = pa.array([*self._units(units), self.end], pa.binary())
        ends = np.searchsorted(starts, offsets[1:])  # units before the end of each text
        taken = values.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(units))))
        bounds = np.frombuffer(taken.buffers()[1], np.int32)[np.append(0, ends + np.arange(1, len(ends) + 1))]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(bounds), taken.buffers()[2]])

    def __call__(self, texts: pa.Array) -> Iterator[pa.Array]:
        """The packed ids of strings (null: empty), in arrays of some of them."""
        if not self.direct:
            for some in groups(strings(texts)):
                yield pa.array([ids + self.end for ids in self.pieces(some)], pa.binary())
            return
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            done = int(sizes[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + GROUP_BYTES, "right")))
            yield self._cut(texts.slice(at, to - at))
            at = to


def together(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches as one, up to some bytes."""
    held, total = [], 0
    for batch in batches:
        if held and total + batch.nbytes > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += batch.nbytes
    if held:
        yield pa.concat_batches(held)


@lru_cache(maxsize=2)
def encoder(path: str, width: str, end_id: int) -> LibraryEncoder:
    return LibraryEncoder(path, width, end_id)


def width_of(vocab_size: int) -> str:
    """Ids travel as 16-bit integers where the vocabulary allows it."""
    return "<u2" if vocab_size <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, vocab_size: int) -> DataFrame:
    """doc_id, n_tokens (with the end id) and packed ids of every document."""
    width = width_of(vocab_size)
    each = np.dtype(width).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, width, end_id)
        for batch in together(batches, GROUP_BYTES):
            at = 0
            for packed in enc(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(packed)), pc.divide(pc.binary_length(packed).cast(pa.int64()), each), packed], ["doc_id", "n_tokens", "ids"])
                at += len(packed)

    docs = pick(docs, "doc_id", "text")
    return docs.select(docs.doc_id.cast("long"), docs.text).mapInArrow(tidy(run), "doc_id long, n_tokens long, ids binary")


# ---- the coder ------------------------------------------------------------------------


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, in proportion to the counts, at least 1 for each
    symbol that occurs (the largest ones give or take what rounding leaves)."""
    total, out = int(counts.sum()), np.zeros(len(counts), np.int64)
    if not total:
        return out
    out[counts > 0] = np.maximum(1, counts[counts > 0].astype(np.float64) / total * (1 << bits)).astype(np.int64)
    rest = (1 << bits) - int(out.sum())
    for i in np.argsort(-out, kind="stable"):
        step = max(rest, 1 - int(out[i])) if rest < 0 else rest
        out[i] += step
        rest -= step
        if not rest:
            return out
    raise ValueError("more symbols than the scale has slots")


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        symbol = np.repeat(np.arange(len(freq), dtype=np.int64), freq)
        self.filler = symbol[0] if len(symbol) else 0
        # All that a slot tells: its symbol, its place among that symbol's slots, their number.
        self.slots = symbol << 40 | (np.arange(len(symbol)) - self.start.astype(np.int64)[symbol]) << 20 | freq.astype(np.int64)[symbol]

    def encode(self, ids: np.ndarray) -> bytes:
        """One block."""
        return self.encode_all([ids])[0]

    def encode_all(self, blocks: list[np.ndarray]) -> list[bytes]:
        """Blocks by themselves, coded side by side: a step on more lanes costs little more."""
        lanes = LANES
        steps = np.array([-(-len(ids) // lanes) for ids in blocks])
        order = np.argsort(-steps, kind="stable")  # those with a step t stand in front
        most_steps = int(steps.max())
        grid = np.full((most_steps, len(blocks), lanes), self.filler, np.uint32)
        for at, b in enumerate(order):
            whole = len(blocks[b]) // lanes
            grid[:whole, at] = blocks[b][: whole * lanes].reshape(whole, lanes)
            grid[whole : whole + 1, at, : len(blocks[b]) - whole * lanes] = blocks[b][whole * lanes :]
        grid = grid.reshape(most_steps, -1)
        freq, start = self.freq[grid], self.start[grid]
        if not freq.all():
            raise ValueError("an id that the table lacks")
        width = lanes * np.searchsorted(-steps[order], -np.arange(most_steps), "left")  # lanes with a step t
        state = np.full(lanes * len(blocks), LOW, np.uint64)
        words, full = np.empty(grid.shape, np.uint32), np.empty(grid.shape, bool)
        n_seg = -(-steps // STEPS)
        states = np.empty((-(-most_steps // STEPS), len(state)), np.uint64)
        scale, half, room = np.uint64(1 << SCALE_BITS), np.uint64(32), np.uint64(63 - SCALE_BITS)
        for t in range(most_steps - 1, -1, -1):
            w = int(width[t])
            x, f, over = state[:w], freq[t, :w], full[t, :w]
            np.greater_equal(x, f << room, out=over)
            words[t, :w] = x
            x = np.where(over, x >> half, x)
            x += x // f * (scale - f)  # the quotient by f goes above the scale, the rest stays
            x += start[t, :w]
            state[:w] = x
            if t % STEPS == 0:
                states[t // STEPS] = state
        out = [b""] * len(blocks)
        for at, b in enumerate(order):
            ids, mine = blocks[b], slice(at * lanes, (at + 1) * lanes)
            over = full[: steps[b], mine]
            places = np.concatenate([[0], np.cumsum(over.sum(axis=1))]).astype(np.uint32)
            parts = [_HEADER.pack(MAGIC, len(ids), lanes, int(n_seg[b]), int(places[-1]))]
            for s in range(n_seg[b]):
                crc = zlib.crc32(np.ascontiguousarray(ids[s * STEPS * lanes : (s + 1) * STEPS * lanes], "<u4").tobytes())
                parts += [struct.pack("<II", crc, int(places[s * STEPS])), states[s, mine].astype("<u8").tobytes()]
            out[b] = b"".join([*parts, words[: steps[b], mine][over].astype("<u4").tobytes()])
        return out

    def decode(self, block: bytes) -> np.ndarray:
        """The ids of a block."""
        return self.decode_all([block])[0]

    def decode_all(self, blocks: list[bytes]) -> list[np.ndarray]:
        """The ids of each block; all segments of all blocks are decoded side by side."""
        crcs, places, steps, states, words, sizes, held = [], [], [], [], [], [], 0
        for block in blocks:
            magic, n, lanes, n_seg, n_words = _HEADER.unpack_from(block)
            if magic != MAGIC or lanes != LANES:
                raise ValueError("not a block")
            at, size = _HEADER.size, 8 + 8 * lanes
            for s in range(n_seg):
                crc, place = struct.unpack_from("<II", block, at + s * size)
                crcs.append(crc)
                places.append(held + place)
                steps.append(min(STEPS, -(-n // lanes) - s * STEPS))
                states.append(np.frombuffer(block, "<i8", lanes, at + s * size + 8))
            words.append(np.frombuffer(block, "<u4", n_words, at + n_seg * size))
            sizes.append((n, n_seg))
            held += n_words
        order = np.argsort(-np.array(steps), kind="stable")  # those with a step t stand in front
        steps, places, state = np.array(steps)[order], np.array(places)[order], np.stack(states)[order]
        words = np.concatenate(words).astype(np.int64)
        out = np.zeros((len(order), STEPS, LANES), np.uint32)
        few, low = (1 << 20) - 1, int(LOW)
        active = np.searchsorted(-steps, -np.arange(steps[0]), "left")
        for t, k in enumerate(active.tolist()):
            x = state[:k]
            slot = self.slots[x & ((1 << SCALE_BITS) - 1)]
            out[:k, t] = slot >> 40
            x >>= SCALE_BITS
            x *= slot & few
            x += slot >> 20 & few
            need = x < low
            number = np.count_nonzero(need, axis=1)
            ends = np.cumsum(number)
            at = np.flatnonzero(need)
            word = np.arange(len(at)) + np.repeat(places[:k] - (ends - number), number)
            flat = x.reshape(-1)
            flat[at] = flat[at] << 32 | words.take(word, mode="clip")  # broken places end at the checksum
            places[:k] += number
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        out, found, first = out[back], [], 0
        for n, n_seg in sizes:
            ids = out[first : first + n_seg].reshape(-1)[:n]
            for s in range(n_seg):
                if zlib.crc32(ids[s * STEPS * LANES : (s + 1) * STEPS * LANES].astype("<u4").tobytes()) != crcs[first + s]:
                    raise ValueError(f"checksum of segment {s} differs")
            found.append(ids)
            first += n_seg
        return found


# ---- writing and reading --------------------------------------------------------------

_BLOCK = "bucket long, block long, start long, n_ids long, doc_ids array<long>, pieces array<long>, first_start long, payload binary"


def write(tokens: DataFrame, path: str, vocab_size: int, n_buckets: int, block_ids: int = BLOCK_IDS) -> None:
    """Write packed ids (doc_id, n_tokens, ids) as blocks under ``path``.

    What reaches the driver: at most one count per vocabulary entry, and one boundary and
    one sum per bucket.
    """
    spark, width = tokens.sparkSession, width_of(vocab_size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(vocab_size, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                seen += np.bincount(np.frombuffer(b"".join(batch.column(0).slice(i, 1024).to_pylist()), width), minlength=vocab_size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(tidy(count), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocab_size, np.int64)
    for r in rows:
        counts[r.id] = r.n
    freq = scaled(counts)
    table = spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq.tolist()) if f], "id long, freq long")
    table.coalesce(1).write.parquet(f"{path}/table")

    cuts = tokens.agg(F.percentile_approx("doc_id", [i / n_buckets for i in range(1, n_buckets)] or [0.5], 20 * n_buckets)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))
    bucket = F.lit(0)
    if len(cuts):  # a balanced tree of comparisons
        def tree(lo: int, hi: int):
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(F.col("doc_id") < int(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

        bucket = F.coalesce(tree(0, len(cuts)), F.lit(0))
    placed = tokens.withColumn("bucket", bucket.cast("long"))
    sums = {r.bucket: r.n for r in placed.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()}
    before, starts = 0, {}
    for b in sorted(sums):
        starts[b], before = before, before + sums[b]

    longs = pa.list_(pa.int64())
    schema = pa.schema(list(zip(("bucket", "block", "start", "n_ids", "doc_ids", "pieces", "first_start", "payload"), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), longs, longs, pa.int64(), pa.binary()), strict=True)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # what a worker remembered for the texts
        coder = Coder(freq)
        now, number, start, docs, parts, size, first = None, 0, 0, [], [], 0, 0
        full: list[tuple] = []

        def close() -> Iterator[pa.RecordBatch]:
            full.append((now, number, start, size, [d for d, _ in docs], [k for _, k in docs], first, np.concatenate(parts)))
            if len(full) == SIDE:
                yield flush()

        def flush() -> pa.RecordBatch:
            *columns, ids = zip(*full, strict=True)
            full.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([*columns, coder.encode_all(ids)], schema, strict=True)], schema=schema)

        for batch in batches:
            for b, doc, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if b != now:
                    if size:
                        yield from close()
                    now, number, start, docs, parts, size = b, 0, starts[b], [], [], 0
                ids, begin = np.frombuffer(packed.as_buffer(), width), start + size
                while len(ids):
                    if not size:
                        first = begin
                    k = min(len(ids), block_ids - size)
                    docs.append((doc, k))
                    parts.append(ids[:k])
                    size, ids = size + k, ids[k:]
                    if size == block_ids:
                        yield from close()
                        number, start, docs, parts, size = number + 1, start + size, [], [], 0
        if size:
            yield from close()
        if full:
            yield flush()

    ordered = placed.select("bucket", "doc_id", "ids").repartitionById(max(n_buckets, 1), F.col("bucket").cast("int")).sortWithinPartitions("bucket", "doc_id", "ids")
    ordered.mapInArrow(tidy(blocks), _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _times(m: list[int], v: int) -> int:
    out, i = 0, 0
    while v:
        if v & 1:
            out ^= m[i]
        v >>= 1
        i += 1
    return out


def crc32_joined(a: int, b: int, b_bytes: int) -> int:
    """crc32 of two byte strings in a row, from their own and the second's length: the
    first passes through b_bytes zero bytes, a linear map over bits."""
    step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        step = [_times(step, x) for x in step]  # one zero byte
    while b_bytes:
        if b_bytes & 1:
            a = _times(step, a)
        b_bytes >>= 1
        if b_bytes:
            step = [_times(step, x) for x in step]
    return a ^ b


def read(spark: SparkSession, path: str) -> DataFrame:
    """From the files alone: doc_id, start, n_tokens, ids_crc32 of every document."""
    rows = spark.read.parquet(f"{path}/table").collect()  # at most one row per vocabulary entry
    freq = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        freq[r.id] = r.freq

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            payloads = (batch.column(4).slice(i, SIDE).to_pylist() for i in range(0, batch.num_rows, SIDE))
            decoded = chain.from_iterable(map(coder.decode_all, payloads))
            for start, docs, pieces, first, ids in zip(*(batch.column(i) for i in range(4)), decoded, strict=True):
                n = np.array(pieces.as_py(), np.int64)
                ends = np.cumsum(n)
                at = ends - n
                begin = start.as_py() + at
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
                piece = begin.copy()
                begin[0] = first.as_py()
                inner = np.ones(len(n), bool)  # what is at a block's end may go on in another
                inner[0] = inner[-1] = False
                yield pa.RecordBatch.from_arrays([docs.values.cast(pa.int64()), pa.array(begin), pa.array(piece), pa.array(n), pa.array(crc, pa.int64()), pa.array(inner)], ["doc_id", "start", "piece", "n", "crc", "whole"])

    parts = spark.read.parquet(f"{path}/blocks").select("start", "doc_ids", "pieces", "first_start", "payload").mapInArrow(tidy(decode), "doc_id long, start long, piece long, n long, crc long, whole boolean")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = batch.column(3).to_pylist()
            for i in np.flatnonzero(batch.column(4).is_valid().to_numpy(zero_copy_only=False)).tolist():
                found = sorted((x["piece"], x["n"], x["crc"]) for x in batch.column(4)[i].as_py())
                crc[i] = found[0][2]
                for _, n, c in found[1:]:
                    crc[i] = crc32_joined(crc[i], c, 4 * n)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # A document in one piece has its checksum; only the pieces of split ones are gathered and joined.
    whole = parts.groupBy("doc_id", "start").agg(F.sum("n").alias("n_tokens"), F.count("*").alias("k"), F.max("crc").alias("crc"), F.collect_list(F.when(~F.col("whole"), F.struct("piece", "n", "crc"))).alias("found"))
    return whole.select("doc_id", "start", "n_tokens", "crc", F.when(F.col("k") > 1, F.col("found")).alias("found")).mapInArrow(tidy(joined), "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_and_read(docs: DataFrame, tokenizer_path: str, *, end_id: int = 0, vocab_size: int, n_buckets: int | None = None) -> DataFrame:
    """Encode, write, read back."""
    spark = docs.sparkSession
    n_buckets = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens = materialize(tokenize(docs, tokenizer_path, end_id, vocab_size), "tokens")
    path = new_path(spark, "blocks")
    write(tokens, path, vocab_size, n_buckets)
    return read(spark, path)
