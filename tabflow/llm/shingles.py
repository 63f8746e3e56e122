"""Word shingles and MinHash signatures in numpy, shared by the near-duplicate operators."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORDS = 5
CHUNK = 1 << 18               # bytes hashed at a time
LONG_WORD = 512               # longer words are hashed by xxh3
ROWS_AT_ONCE = 2048
BLANK = re.compile(rb"[\x20\x09-\x0D]")
LOWER_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2 ** 64, n, dtype=np.uint64) | np.uint64(1)


_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, *range(9, 14)]] = True
_LETTERS = _odd(256, 5)                       # a random number per byte, A-Z as a-z
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B]
_FACTORS = _odd(max(WORDS, 64), 17)
# powers of an odd number and of its inverse modulo 2^64
_POWERS = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(CHUNK + LONG_WORD, np.uint64(0x9E3779B97F4A7C15)))))
_INVERSE = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(
    CHUNK + LONG_WORD, np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))))))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text, in order; words end at blanks and the bytes 9 to 13, A-Z is
    lower-cased.

    A running sum of letter * power gives every word's polynomial as one difference, scaled back to the
    word's own start, whatever the word's place; a mixer follows.
    """
    parts, at = [], 0
    while at < len(raw):
        end = at + CHUNK
        if end < len(raw):
            found = BLANK.search(raw, end)
            end = found.start() if found else len(raw)
        parts.append(_chunk_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _chunk_hashes(raw: bytes) -> np.ndarray:
    if len(raw) >= len(_POWERS):              # a word that runs on for a whole chunk
        return np.array([_long_hash(w) if len(w) >= LONG_WORD else word_hashes(w)[0] for w in raw.translate(LOWER_BYTES).split()], np.uint64)
    b = np.frombuffer(raw, np.uint8)
    blank = _BLANKS[b]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edges = np.concatenate(([0], edges))
    if not blank[-1]:
        edges = np.concatenate((edges, [len(b)]))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_LETTERS[b] * _POWERS[:len(b)], out=sums[1:])
    sizes = ends - starts
    hashes = _mixed((sums[ends] - sums[starts]) * _INVERSE[starts] + sizes.astype(np.uint64) * _LETTERS[0])
    for i in np.flatnonzero(sizes >= LONG_WORD):
        hashes[i] = _long_hash(raw[starts[i]:ends[i]].translate(LOWER_BYTES))
    return hashes


def _long_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingle_set(raw: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    A text of fewer words has its whole sequence as its only shingle, one without words none.
    """
    hashes = word_hashes(raw) if raw else np.zeros(0, np.uint64)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    total = np.full(n, np.uint64(width))
    for j in range(width):
        total += hashes[j:j + n] * _FACTORS[j]
    ordered = np.sort(_mixed(total))
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))]


class Permutations:
    """``k`` universal hash functions x -> (a x + b) mod 2^32 with odd a over the upper halves of the shingle
    hashes.  32-bit products are what numpy multiplies fastest."""

    def __init__(self, k: int, seed: int = 1):
        self.k = k
        self.a = (_odd(k, seed) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
        self.b = (_odd(k, seed + 1) >> np.uint64(32)).astype(np.uint32)[:, None]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The minimum of every function over a set that is not empty."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.k, np.uint32(2 ** 32 - 1))
        for at in range(0, len(x), ROWS_AT_ONCE):
            values = self.a * x[at:at + ROWS_AT_ONCE]
            values += self.b
            least = np.minimum(least, values.min(axis=1))
        return least


def set_key(shingles: np.ndarray) -> bytes:
    """128-bit digest of a set: equal sets have equal keys."""
    return xxhash.xxh3_128_digest(shingles.tobytes())
