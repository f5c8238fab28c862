"""Operator 9: language identification by rank-order profiles.

A text's letters, lower-cased, with everything else as one blank, give its n-grams of one
to three characters, those inside words with one blank on either side.  A language's
profile is the order of its PROFILE most frequent n-grams over all documents learnt from;
a document's own order is held against each profile by the out-of-place distance, an n-gram
that the profile lacks counting PROFILE places.  The least distance wins.

Learnt from: text and non-null lang of documents whose crc32 of doc_id (as text) mod 4 is
not 2.  Counts cover all of them; each task sums its own first.

Defined results: null text, text without a letter, and a table with nothing to learn from
give ``und`` and score 0; ties go to the n-gram with the smaller code and to the language
that sorts first; repeated rows give repeated results; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import groups, pick, strings, tidy

PROFILE = 400
HELD_OUT = 2
UNKNOWN = "und"
#: Distinct n-grams that a task sums before it passes them on.
FLUSH = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as sorted codes, and their counts.

    Code points take 21 bits.  A trigram has a letter in the middle, a bigram leaves the
    middle empty, a single letter has the top bit.
    """
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    c = np.where(_letters()[c], c, 0).astype(np.uint64)
    c = np.concatenate([[0], c, [0]]).astype(np.uint64)
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    if not c.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    s1, s2, top = np.uint64(21), np.uint64(42), np.uint64(1 << 63)
    one = c[c != 0] | top
    two = (c[:-1] << s2) | c[1:]
    three = ((c[:-2] << s2) | (c[1:-1] << s1) | c[2:])[c[1:-1] != 0]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def order(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent keys, most frequent first, ties by key."""
    if len(keys) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))][:most]


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles by language: at most ``size`` codes for each."""
    docs = pick(docs, "doc_id", "text", "lang")
    docs = docs.filter(docs.lang.isNotNull() & docs.text.isNotNull() & (F.coalesce(F.crc32(docs.doc_id.cast("string")) % 4, F.lit(0)) != HELD_OUT))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def merged(found: list) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in sums.items():
                keys, n = merged(found)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(_signed(keys)), pa.array(n)], ["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                keys, n = grams(text)
                found = sums.setdefault(lang, [])
                found.append((keys, n))
                held += len(keys)
                if held > FLUSH:
                    held = 0
                    for name in sums:
                        sums[name] = [merged(sums[name])]
                        held += len(sums[name][0][0])
                    if held > FLUSH // 2:
                        yield from flush()
                        held = 0
        yield from flush()

    counted = docs.select("lang", "text").mapInArrow(tidy(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # As the codes are unsigned, those with the top bit come last.
    first = Window.partitionBy("lang").orderBy(F.desc("n"), F.col("gram") < 0, "gram")
    rows = counted.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= size).select("lang", "gram", "rank").collect()
    profiles: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.rank)):
        profiles.setdefault(r.lang, []).append(r.gram)
    return profiles


class Identifier:
    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size, self.langs = size, sorted(profiles)
        everything = np.array([g for lang in self.langs for g in profiles[lang]], np.int64).view(np.uint64)
        self.keys = np.unique(everything)
        self.rank = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            own = np.array(profiles[lang], np.int64).view(np.uint64)
            self.rank[np.searchsorted(self.keys, own), j] = np.arange(len(own))

    def __call__(self, text: str) -> tuple[str, float]:
        keys, n = grams(text)
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        own = order(keys, n, self.size)
        at = np.searchsorted(self.keys, own)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != own)] = len(self.keys)
        rank = self.rank[at]
        out = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(out))
        return self.langs[best], 1.0 - float(out[best]) / (self.size * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identify = Identifier(profiles, size)
        for batch in batches:
            at = 0
            for texts in groups(strings(batch.column(1))):
                ids = batch.column(0).slice(at, len(texts))
                found = [identify(t) for t in texts]
                held = [i is not None and zlib.crc32(str(i).encode()) % 4 == HELD_OUT for i in ids.to_pylist()]
                yield pa.RecordBatch.from_arrays([ids, pa.array(held), pa.array([f[0] for f in found]), pa.array([f[1] for f in found])], ["doc_id", "held_out", "lang_pred", "score"])
                at += len(texts)

    docs = pick(docs, "doc_id", "text")
    return docs.select(docs.doc_id.cast("long"), docs.text).mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double")
