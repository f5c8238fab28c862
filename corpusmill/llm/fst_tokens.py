"""Operator 5: token counts by compiled finite-state transducers.

Two deterministic transducers read the normalised text.  The first walks over classes of
characters and cuts the text as the tokenizer's splitting pattern does; the second reads the
bytes of one match, the last of them as its own symbol, and its transitions are annotated with
the change of the token count.  It is a subset construction, compiled as it is met: a state
holds, for each place where a token could have begun, the node of the token trie, the last
token before the place and the token count up to there, relative to the present one.  Merges
by rank have the property that two tokens may follow each other if and only if the merges leave
that pair as it is, so at most one of them ends at each place.  Together, a transition of the
first that begins a match emits that match's tokens.

A text is dealt into chunks.  A chunk's state map gives, for each state it can be entered in,
the state it is left in and the number of tokens of the matches that begin in it: all states
run in lockstep until they have met, from where on they share one run.  The maps, counts
included, compose by a parallel prefix scan, and a text's count is that of its composed chunks
from the start state.

Defined results: null and empty texts have no bytes and no tokens; repeated rows give
repeated results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm.bpe_codec import BYTE_CHAR
from corpusmill.llm.common import groups, pick, strings, tidy

CHUNK = 512
#: States of the second transducer, and matches, that a worker remembers before it starts afresh.
MAX_STATES = 400_000
MAX_WORDS = 250_000

# ---- the first transducer: where matches begin -----------------------------------------
# Fixed values of the pattern: contractions 's 't 're 've 'm 'll 'd, runs of letters,
# single numbers, runs of anything else, white space dropped.

SPACE, LETTER, NUMBER, OTHER, QUOTE, L_STMD, L_R, L_V, L_E, L_L = range(10)
CLASSES = 10
_LETTERS = {LETTER, L_STMD, L_R, L_V, L_E, L_L}
START, IN_LETTERS, IN_OTHER, AFTER_QUOTE, QUOTE_E, QUOTE_L, DONE = range(7)
STATES = 7
CUT_HERE, CUT_BEFORE_LAST = 1, 2


def _fresh(c: int) -> tuple[int, int]:
    """State and cuts where a character of class c begins a match."""
    if c == SPACE:
        return START, 0
    if c in _LETTERS:
        return IN_LETTERS, CUT_HERE
    if c == NUMBER:
        return DONE, CUT_HERE
    if c == QUOTE:
        return AFTER_QUOTE, CUT_HERE
    return IN_OTHER, CUT_HERE


def _step(state: int, c: int) -> tuple[int, int]:
    if state == IN_LETTERS and c in _LETTERS:
        return IN_LETTERS, 0
    if state in (IN_OTHER, AFTER_QUOTE) and c in (OTHER, QUOTE):
        return IN_OTHER, 0
    if state == AFTER_QUOTE:
        if c == L_STMD:
            return DONE, 0
        if c in (L_R, L_V):
            return QUOTE_E, 0
        if c == L_L:
            return QUOTE_L, 0
    if state in (QUOTE_E, QUOTE_L):  # the quote is a match unless this letter ends a contraction
        if c == (L_E if state == QUOTE_E else L_L):
            return DONE, 0
        if c in _LETTERS:
            return IN_LETTERS, CUT_BEFORE_LAST
        after, cut = _fresh(c)
        return after, cut | CUT_BEFORE_LAST
    return _fresh(c)


NEXT = np.array([[_step(s, c)[0] for s in range(STATES)] for c in range(CLASSES)], np.int64).reshape(-1)
CUTS = np.array([[_step(s, c)[1] for s in range(STATES)] for c in range(CLASSES)], np.uint8).reshape(-1)
_STEPS = [[_step(s, c) for s in range(STATES)] for c in range(CLASSES)]


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point, as lower-case letters and separators stand in the pattern."""
    import regex

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for pattern, c in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        table[np.frombuffer("".join(regex.findall(pattern, everything)).encode("utf-32-le"), np.uint32)] = c
    for chars, c in (("'", QUOTE), ("stmd", L_STMD), ("r", L_R), ("v", L_V), ("e", L_E), ("l", L_L)):
        for x in chars:
            table[ord(x)] = c
    return table


Maps = tuple[np.ndarray, np.ndarray]  # by chunk and entry state: exit state, tokens


def compose(first: Maps, second: Maps) -> Maps:
    """What two chunks in a row do, pair by pair."""
    (left, n), (out, m) = first, second
    return np.take_along_axis(out, left, axis=1), n + np.take_along_axis(m, left, axis=1)


def scan(maps: Maps) -> Maps:
    """Inclusive prefix composition, by doubling: log2 rounds over all chunks at once."""
    (out, n), step = (maps[0].copy(), maps[1].copy()), 1
    while step < len(out):
        out[step:], n[step:] = compose((out[:-step], n[:-step]), (out[step:], n[step:]))
        step *= 2
    return out, n


def match_end(classes: np.ndarray, at: int) -> int:
    """Where the match that begins here ends."""
    state, t = _fresh(int(classes[at]))[0], at + 1
    while t < len(classes):
        state, cut = _STEPS[int(classes[t])][state]
        if cut & CUT_BEFORE_LAST:
            return t - 1
        if cut or classes[t] == SPACE:
            return t
        t += 1
    return t


def state_maps(classes: np.ndarray, begin: np.ndarray, size: np.ndarray, tokens: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Maps:
    """Maps of chunks of at most CHUNK characters; ``tokens`` counts matches (begins, ends)."""
    rows = len(begin)
    place = begin[:, None] + np.arange(CHUNK)
    inside = np.arange(CHUNK) < size[:, None]
    grid = np.where(inside, classes[np.minimum(place, len(classes) - 1)], SPACE).T.astype(np.int64) * STATES
    # All states in lockstep until a chunk's states have met.
    state, live = np.tile(np.arange(STATES), (rows, 1)), np.arange(rows)
    since, out = np.full(rows, CHUNK), np.empty((rows, STATES), np.int64)
    heads: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for t in range(CHUNK):
        at = grid[t, live][:, None] + state
        cut, state = CUTS.take(at), NEXT.take(at)
        if cut.any():
            for kind, back in ((CUT_HERE, 0), (CUT_BEFORE_LAST, 1)):
                r, s = np.nonzero(cut & kind)
                heads.append((live[r], s, begin[live[r]] + t - back))
        met = (state == state[:, :1]).all(axis=1)
        if met.any():
            since[live[met]] = t + 1
            out[live[met]] = state[met]
            live, state = live[~met], state[~met]
        if not len(live):
            break
    out[live] = state
    # From there, one run for all.
    order = np.argsort(since, kind="stable")
    bound, one = since[order], out[order, 0]
    cuts = np.zeros((CHUNK, rows), np.uint8)
    for t in range(int(bound[0]) if rows else CHUNK, CHUNK):
        k = int(np.searchsorted(bound, t, side="right"))
        at = grid[t, order[:k]] + one[:k]
        cuts[t, :k] = CUTS.take(at)
        one[:k] = NEXT.take(at)
    out[order[bound < CHUNK]] = one[bound < CHUNK][:, None]
    back = np.empty(rows, np.int64)
    back[order] = np.arange(rows)
    cuts = cuts.T[back]
    r1, t1 = np.nonzero(cuts & CUT_HERE)
    r2, t2 = np.nonzero(cuts & CUT_BEFORE_LAST)
    row, start = np.concatenate([r1, r2]), np.concatenate([begin[r1] + t1, begin[r2] + t2 - 1])
    by = np.lexsort((start, row))
    row, start = row[by], start[by]
    n = np.zeros((rows, STATES), np.int64)
    blank = np.append(np.flatnonzero(classes == SPACE), len(classes))
    if len(row):
        end = blank[np.searchsorted(blank, start)]
        last = np.append(row[1:] != row[:-1], True)
        end[:-1] = np.where(last[:-1], end[:-1], np.minimum(end[:-1], start[1:]))
        for i in np.flatnonzero(last & (end >= begin[row] + size[row])).tolist():  # it goes on in the next chunk
            end[i] = match_end(classes, int(start[i]))
        n += np.bincount(row, weights=tokens(start, end), minlength=rows).astype(np.int64)[:, None]
    if heads:
        r, s, start = (np.concatenate(x) for x in zip(*heads, strict=True))
        some, at = np.unique(start, return_inverse=True)
        real = (some >= 0) & (classes[some] != SPACE)  # no state that is reached has others
        end = np.array([match_end(classes, p) if ok else 0 for p, ok in zip(some.tolist(), real.tolist(), strict=True)], np.int64)
        got = np.zeros(len(some), np.int64)
        got[real] = tokens(some[real], end[real])
        np.add.at(n, (r, s), got[at])
    return out, n


# ---- the second transducer: tokens of one match ----------------------------------------


def _pack(node: int, last: int, count: int) -> int:
    """Node, last token (under 2**20, or -1) and relative count, which a token's length bounds."""
    return node << 28 | last + 1 << 8 | count + 128


class MatchTransducer:
    """Counts the tokens of one match; see the module's text."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        back = {c: b for b, c in BYTE_CHAR.items()}

        def symbols(piece: str) -> tuple[int, ...]:
            ends = piece.endswith(suffix) and len(piece) > len(suffix)
            out = [back[c] for c in (piece[: -len(suffix)] if ends else piece)]
            if ends:
                out[-1] += 256
            return tuple(out)

        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(merges)}
        self.suffix = suffix
        self.piece = [""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.piece[i] = piece
        self.children: list[dict[int, int]] = [{}]
        self.token = [-1]
        produced = {BYTE_CHAR[b] + s for b in range(256) for s in ("", suffix)} | {a + b for a, b in self.rank}
        for piece, i in vocab.items():
            if piece not in produced:
                continue
            node = 0
            for s in symbols(piece):
                if s not in self.children[node]:
                    self.children[node][s] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][s]
            self.token[node] = i
        self.fits: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        """Drop what was compiled."""
        self.states: list[tuple[int, ...]] = [(_pack(0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.next: dict[int, tuple[int, int]] = {}

    def _merged(self, piece: str) -> list[str]:
        ends = piece.endswith(self.suffix) and len(piece) > len(self.suffix)
        parts = list(piece[: -len(self.suffix)] if ends else piece)
        if ends:
            parts[-1] += self.suffix
        while len(parts) > 1:
            best = min(((self.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == 1 << 30:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def _fit(self, last: int, token: int) -> bool:
        key = (last, token)
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > 4 * MAX_STATES:
                self.fits.clear()
            pair = [self.piece[token]] if last < 0 else [self.piece[last], self.piece[token]]
            known = self.fits[key] = self._merged("".join(pair)) == pair
        return known

    def _compile(self, state: int, symbol: int) -> tuple[int, int]:
        active, ended = [], None
        for packed in self.states[state]:
            last, count = (packed >> 8 & 0xFFFFF) - 1, (packed & 0xFF) - 128
            child = self.children[packed >> 28].get(symbol)
            if child is None:
                continue
            active.append((child, last, count))
            token = self.token[child]
            if token >= 0 and ended is None and self._fit(last, token):
                ended = (token, count + 1)
        token, change = ended
        if symbol >= 256:  # the match ends here
            found = (0, change)
        else:
            key = (*[_pack(n, k, c - change) for n, k, c in active if self.children[n]], _pack(0, token, 0))
            if (number := self.number.get(key)) is None:
                number = self.number[key] = len(self.states)
                self.states.append(key)
            found = (number, change)
        self.next[state << 9 | symbol] = found
        return found

    def count(self, match: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self.forget()
        get, state, total = self.next.get, 0, 0
        for b in match[:-1]:
            state, change = get(state << 9 | b) or self._compile(state, b)
            total += change
        return total + (get(state << 9 | match[-1] | 256) or self._compile(state, match[-1] | 256))[1]


# ---- texts ------------------------------------------------------------------------------


class _Counts(dict):
    """Counts of matches met; ``old`` are those met before the last change of generation."""

    def __init__(self, transducer: MatchTransducer):
        super().__init__()
        self.transducer, self.old = transducer, {}

    def __missing__(self, match: str) -> int:
        n = self.old.get(match)
        if n is None:
            n = self.transducer.count(match.encode())
        self[match] = n
        return n

    def age(self) -> None:
        if len(self) > MAX_WORDS:
            self.old = dict(self)
            self.clear()


class Counter:
    """Compiled from a tokenizers file with the normaliser and pattern this module knows."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        splits = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or splits != ["Split", "ByteLevel"]:
            raise ValueError("a tokenizer of another kind")
        model = spec["model"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.plain = re.compile("[^\x00-˿]")  # below, normalising is lower case alone
        self.counts = _Counts(MatchTransducer(model["vocab"], model["merges"], model["end_of_word_suffix"]))
        self.table = class_table()

    def _normal(self, text: str) -> str:
        return self.normalizer.normalize_str(text) if self.plain.search(text) else text.lower()

    def __call__(self, texts: list[str]) -> np.ndarray:
        extra = np.zeros(len(texts), np.int64)
        parts, sizes, of = [], [], []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):  # each is one token, and the text is cut there
                found = self.split_special.split(text)
                extra[i] = len(found) - 1
            else:
                found = [text]
            for x in found:
                parts.append(self._normal(x) + "\n")
                sizes.append(len(parts[-1]))
                of.append(i)
        big, sizes = "".join(parts), np.array(sizes, np.int64)
        classes = self.table[np.frombuffer(big.encode("utf-32-le"), np.uint32)]
        # A part begins and ends in the start state, so the scan may run through all of them.
        chunks = -(-sizes // CHUNK)
        ends = np.cumsum(chunks)
        number = np.arange(ends[-1]) - np.repeat(ends - chunks, chunks)
        begin = np.repeat(np.cumsum(sizes) - sizes, chunks) + number * CHUNK
        self.counts.age()
        counts = self.counts

        def tokens(start: np.ndarray, end: np.ndarray) -> np.ndarray:
            return np.array([counts[big[a:b]] for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.int64)

        size = np.minimum(CHUNK, np.repeat(np.cumsum(sizes), chunks) - begin)
        _, upto = scan(state_maps(classes, begin, size, tokens))
        total = np.diff(upto[ends - 1, START], prepend=0)
        return np.bincount(np.array(of), weights=total, minlength=len(texts)).astype(np.int64) + extra


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text)."""
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    schema = T.StructType([T.StructField(n, t()) for n, t in zip(names, (T.LongType, T.LongType, T.LongType, T.BooleanType), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer_path)
        for batch in batches:
            at = 0
            for texts in groups(strings(batch.column(1))):
                n = c(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)], names)
                at += len(texts)

    docs = pick(docs, "doc_id", "text")
    return docs.select(docs.doc_id.cast("long"), docs.text).mapInArrow(tidy(run), schema)
