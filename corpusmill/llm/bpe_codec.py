"""Operator 1: byte-level BPE encoding and decoding with a sentencepiece model.

The model is serialised straight from a rank file: every token's bytes are mapped to
printable characters, one per byte, and become a piece whose score is its negative rank;
normalisation is the identity.  Sentencepiece's BPE joins the neighbours with the best
score first, which is the order of the ranks.  Each match of the splitting pattern is
encoded by itself; decoding maps pieces back to bytes.

Defined results: null text is empty text; empty text has no ids; repeated rows give
repeated results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm.common import CACHE_PIECES, PieceEncoder, groups, pick, strings, tidy

#: One printable character for each byte, so that a piece is a plain string: bytes that
#: print as they are stand for themselves, the others follow from code point 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_REST = [b for b in range(256) if b not in set(_PRINTABLE)]
BYTE_CHAR = {**{b: chr(b) for b in _PRINTABLE}, **{b: chr(256 + i) for i, b in enumerate(_REST)}}
CHAR_BYTE = {c: b for b, c in BYTE_CHAR.items()}
_TO_CHARS = {b: BYTE_CHAR[b] for b in range(256)}

#: Stands for no byte sequence at all, so it cannot be met in a text.
UNKNOWN = "▁▁"


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, in the order of their ranks, which must run from 0."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(r): base64.b64decode(t) for t, r in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def to_chars(data: bytes) -> str:
    if data[:1] == b" " and data[1:].isalnum():  # ASCII letters and digits stand for themselves
        return "\u0120" + data[1:].decode()
    return data.decode("latin-1").translate(_TO_CHARS)


def to_bytes(chars: str) -> bytes:
    return bytes(CHAR_BYTE[c] for c in chars)


def _field(number: int, payload: bytes) -> bytes:
    """A length-delimited protobuf field."""
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def serialize_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model: the tokens by rank, then the unknown piece."""
    normal, unknown, bpe = 1, 2, 2
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = _field(1, to_chars(token).encode()) + b"\x15" + struct.pack("<f", -float(rank)) + b"\x18" + _varint(normal)
        out += _field(1, piece)
    out += _field(1, _field(1, UNKNOWN.encode()) + b"\x15" + struct.pack("<f", 0.0) + b"\x18" + _varint(unknown))
    trainer = b"\x18" + _varint(bpe) + b"\x20" + _varint(len(tokens) + 1)
    trainer += _varint(40 << 3) + _varint(len(tokens))  # id of the unknown piece
    normalizer = _field(1, b"identity") + b"\x18\x00" + b"\x20\x00" + b"\x28\x00"  # no dummy prefix, no trimming, no escaping
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        tokens = read_ranks(ranks_path)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialize_model(tokens))
        self.split = regex.compile(pattern).findall
        self.bytes_of = [to_bytes(self.model.id_to_piece(i)) for i in range(len(tokens))]
        self.known: dict[str, bytes] = {}
        # A match that is a token as a whole has that token's id; merges almost always lead there anyway.
        got = self.model.encode([to_chars(t) for t in tokens], num_threads=1)
        self.direct = {tokens[i]: [i] for i, ids in enumerate(got) if ids != [i]}
        self.pieces = PieceEncoder(self._matches, self._texts)

    def _matches(self, matches: list[str]) -> list[bytes]:
        if not matches:
            return []
        ids = self.model.encode([to_chars(m.encode()) for m in matches], num_threads=1)
        if self.direct:
            ids = [self.direct.get(m.encode(), x) for m, x in zip(matches, ids, strict=True)]
        return [array("I", x).tobytes() for x in ids]

    def _texts(self, texts: list[str]) -> list[bytes]:
        known, split = self.known, [self.split(t) for t in texts]
        if len(known) > CACHE_PIECES:
            known.clear()
        new = list({w for words in split for w in words}.difference(known))
        known.update(zip(new, self._matches(new), strict=True))
        return [b"".join([known[w] for w in words]) for words in split]

    def forget(self) -> None:
        """Gives back what was remembered of texts."""
        self.known = {}
        self.pieces.forget()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        return self.pieces(texts)

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in array("I", ids)])


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(ranks_path, pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, *, keep_ids: bool = True) -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit; only with ``keep_ids``), n_tokens,
    ids_sha256, decoded_sha256 of every row of ``docs`` (doc_id, text)."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            at = 0
            for texts in groups(strings(batch.column(1))):
                packed = c.encode(texts)
                columns = [batch.column(0).slice(at, len(texts)), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array([sha(p) for p in packed]), pa.array([sha(c.decode(p)) for p in packed])]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(packed, pa.binary())] if keep_ids else []), names)
                at += len(texts)
        c.forget()

    docs = pick(docs, "doc_id", "text")
    return docs.select(docs.doc_id.cast("long"), docs.text).mapInArrow(tidy(run), T.StructType(fields))


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows with doc_id and packed ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.decode(v.as_py() or b"").decode("utf-8", "replace") for v in part.column(1)], pa.string())], ["doc_id", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(tidy(run), "doc_id long, text string")
