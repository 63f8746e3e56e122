"""Byte-level BPE encoding and decoding (operator 2).

A text is cut by the tokenizer's split pattern; every piece is encoded alone.
Bytes are mapped to Latin-1 characters so that one Aho-Corasick automaton over
all tokens finds the longest token starting at every byte of a piece.  Starting
from those longest matches the encoder keeps a token only if it may follow the
one before it: two tokens are compatible when the merges of their joined bytes
give back exactly these two tokens.  On a dead end it falls back to the next
shorter prefix token, and a byte position found dead is never tried again, so
the work is linear in the piece.  The compatibility of a pair is memoised.
The result equals applying the merges in rank order.

Defined results: null and empty texts have no tokens and decode to zero bytes;
repeated rows give repeated results; other columns of the input are not read
(the caller names the id and text columns), so their names cannot clash; an
empty table gives an empty table.  Only bounded data is broadcast: the
vocabulary file itself (under ``MAX_VOCAB_BYTES``, checked).
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_VOCAB_BYTES = 64 << 20
CACHED_PIECES = 100_000       # memo of short pieces; emptied when full
CACHED_PIECE_BYTES = 64
CACHED_PAIRS = 200_000
SLICE_ROWS = 64               # texts turned into Python strings at a time


def read_ranks(raw: bytes) -> list[bytes]:
    """Tokens in rank order from the lines ``base64 rank`` of a rank file."""
    ranked = {int(rank): base64.b64decode(token)
              for token, rank in (line.split() for line in raw.splitlines() if line.strip())}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranked[i] for i in range(len(ranked))]


# packing a few ids costs less than making an array of them
_PACK = [struct.Struct(f"<{n}I").pack for n in range(17)]


class Pairs(dict):
    """(left id, right id) -> may right follow left?  Filled on demand."""

    def __init__(self, codec: "Codec"):
        super().__init__()
        self.codec = codec

    def __missing__(self, pair):
        if len(self) >= CACHED_PAIRS:
            self.clear()
        ok = self[pair] = self.codec.compatible(*pair)
        return ok


class Pieces(dict):
    """piece -> its ids as packed little-endian unsigned 32-bit integers."""

    def __init__(self, codec: "Codec"):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        ids = self.codec.encode_piece(raw)
        packed = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()
        if len(raw) <= CACHED_PIECE_BYTES:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Encoder and decoder for one vocabulary of ranked byte tokens."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.lengths = [len(t) for t in tokens]
        self.pattern = regex.compile(pattern)
        # the longest shorter token that starts like this one (-1: none)
        self.shorter = [next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), -1)
                        for t in tokens]
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = []
        for i, t in enumerate(tokens):
            self.halves.append(self._halves(i, t))
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()
        self.pairs = Pairs(self)
        self.pieces = Pieces(self)

    def _halves(self, i: int, token: bytes) -> tuple[int, int]:
        """The two earlier tokens whose merge makes this one (itself twice for a base token)."""
        for n in range(len(token) - 1, 0, -1):
            left, right = self.ids.get(token[:n], i), self.ids.get(token[n:], i)
            if left < i and right < i and self.compatible(left, right):
                self.merged[left, right] = i
                return left, right
        return i, i

    def compatible(self, left: int, right: int) -> bool:
        """Would the merges of left + right leave exactly these two tokens?

        Undo the later merge of the two sides again and again; if the tokens that then meet at the
        border could have merged before the merges undone so far, the border would not have survived.
        """
        bound = len(self.tokens) + 1
        while True:
            if self.merged.get((left, right), bound) < bound:
                return False
            if left > right:
                bound, left = left, self.halves[left][1]
                if left != bound:
                    continue
                # left was a single byte: go on with the right side
                bound, right = right + 1, self.halves[right][0]
                if right + 1 == bound:
                    return True
            else:
                bound, right = right + 1, self.halves[right][0]
                if right + 1 != bound:
                    continue
                bound, left = left, self.halves[left][1]
                if left == bound:
                    return True

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [-1] * size
        for end, (token, n) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - n + 1] = token     # ends ascend: the longest match comes last
        if -1 in longest:
            raise ValueError("the vocabulary has no token for some byte")
        dead = bytearray(size + 1)
        kept: list[int] = []
        at, candidate = 0, longest[0]
        lengths, pairs, shorter = self.lengths, self.pairs, self.shorter
        while True:
            end = at + lengths[candidate]
            if not dead[end] and (not kept or pairs[kept[-1], candidate]):
                kept.append(candidate)
                at = end
                if at == size:
                    return kept
                candidate = longest[at]
                continue
            candidate = shorter[candidate]
            if candidate < 0:               # nothing fits here: give up this position for good
                dead[at] = 1
                candidate = kept.pop()
                at -= lengths[candidate]

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text."""
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text))) if text else b""

    def decode(self, packed: bytes | None) -> bytes:
        if not packed:
            return b""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


_CODECS: dict[tuple, Codec] = {}


def codec_for(raw: bytes, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = (hash(raw), len(raw), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(read_ranks(raw), pattern)
    return _CODECS[key]


def load_vocab(path: str) -> bytes:
    """The rank file, read on the driver; refused above ``MAX_VOCAB_BYTES``."""
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCAB_BYTES + 1)
    if len(raw) > MAX_VOCAB_BYTES:
        raise ValueError(f"vocabulary file larger than {MAX_VOCAB_BYTES} bytes")
    return raw


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, SLICE_ROWS):
        yield batch.slice(at, SLICE_ROWS)


def encode(df: DataFrame, vocab: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, ``token_ids``): ids packed as little-endian unsigned 32-bit integers, the
    layout of a token shard file.  Narrow: no shuffle; one pass over whole texts."""
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    names = [id_col, *carry]
    rows = df.select(F.col(text_col).cast("string").alias("text"), *[F.col(n).alias(f"c{i}") for i, n in enumerate(names)])
    schema = rows.drop("text").withColumn("token_ids", F.lit(b"")).schema

    def run(batches):
        codec = codec_for(shared.value, pattern)
        for batch in batches:
            for part in _slices(batch):
                packed = [codec.encode(t) for t in part.column("text").to_pylist()]
                yield part.drop_columns(["text"]).append_column("token_ids", pa.array(packed, pa.binary()))

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], "token_ids")


def decode(df: DataFrame, vocab: bytes, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, packed ids, ``decoded``): the bytes of the tokens (UTF-8 of the text they came from)."""
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("token_ids"))
    ids = rows.schema["id"].dataType

    def run(batches):
        tokens = read_ranks(shared.value)
        for batch in batches:
            for part in _slices(batch):
                texts = [b"".join(map(tokens.__getitem__, np.frombuffer(p or b"", dtype="<u4").tolist()))
                         for p in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())],
                                                 ["id", "token_ids", "decoded"])

    out = rows.mapInArrow(run, f"id {ids.simpleString()}, token_ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def token_ids(df: DataFrame, ids_col: str = "token_ids", out: str = "ids") -> DataFrame:
    """The packed ids as an array of integers, for readers that want one."""
    n = F.octet_length(F.col(ids_col))
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(4))).otherwise(F.array().cast("array<int>"))
    word = lambda at: F.conv(F.concat(*[F.hex(F.col(ids_col).substr(at + F.lit(i), F.lit(1)))
                                        for i in (3, 2, 1, 0)]), 16, 10).cast("bigint")
    return df.withColumn(out, F.transform(starts, word))
