"""Fill-in-middle transformation over content-defined chunks (operator 11).

A text becomes prefix, middle and suffix, cut at two seeded unit boundaries (lines, or characters), written in one
of two orders with sentinels, or left plain.  Cuts are found without splitting the text into units:

* a rolling hash over the last ``WINDOW`` bytes cuts the text into chunks where the hash has ``BITS`` zero bits, so
  equal passages give equal chunks wherever they stand (at least ``LEAST``, at most ``MOST`` bytes);
* each chunk is looked up by its content in a cache that a worker keeps for all its texts.  The key is the chunk
  itself, so a found chunk is verified byte by byte.  Its summary says how many line ends and code points it has,
  where its line ends lie, and which sentinel it holds; what lies across a chunk's boundary is decided from
  the bytes on both sides;
* counts of chunks add up: a running sum tells the chunk of a cut, its list of line ends tells the byte.

A cut lies behind the line end number ``k``, so prefix and middle are byte slices, and their code points are sums
over the chunks before and a count in the one that is cut.  The cache holds at most ``CACHE_BYTES`` a worker and starts
anew when full; that changes the time, never the result.  No shuffle; every row is worked on by itself.

Defined results: a null text is empty; an empty text and one that holds a sentinel stay plain (their parts are
null); a null id is the text ``None`` of the seed; rows of one id are cut with the same numbers; other columns named in ``carry``
come along; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WINDOW, BITS = 16, 9
LEAST, MOST = 128, 4096
BLOCK = 1 << 16
CACHE_BYTES = 32 << 20
_ROW_BYTES = 120               # of a cached summary, besides its chunk and line ends
_FACTOR = 0x9E3779B97F4A7C15
_POWERS = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(BLOCK + WINDOW, np.uint64(_FACTOR)))))
_INVERSE = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(
    BLOCK + WINDOW, np.uint64(pow(_FACTOR, -1, 2 ** 64))))))
_BYTES = np.random.default_rng(11).integers(0, 2 ** 64, 256, dtype=np.uint64)


def marks(raw: np.ndarray) -> np.ndarray:
    """Ends of windows of ``WINDOW`` bytes whose rolling hash asks for a cut behind them, ascending."""
    found = []
    for at in range(0, max(0, len(raw) - WINDOW + 1), BLOCK):
        part = raw[at:at + BLOCK + WINDOW - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * _POWERS[:len(part)], out=sums[1:])
        rolled = (sums[WINDOW:] - sums[:-WINDOW]) * _INVERSE[:len(part) - WINDOW + 1]
        found.append(np.flatnonzero((rolled * np.uint64(_FACTOR)) >> np.uint64(64 - BITS) == 0) + at + WINDOW)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(raw: np.ndarray) -> list[int]:
    """Where the chunks of a text end."""
    ends, at, n = [], 0, len(raw)
    asked = marks(raw)
    while n - at > LEAST:
        k = int(np.searchsorted(asked, at + LEAST))
        end = int(asked[k]) if k < len(asked) else n
        end = min(end, at + MOST, n)
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


@dataclass(frozen=True)
class Summary:
    """What a chunk adds to its text: line ends, code points (bytes that begin one), where its units end, and whether it
    holds a sentinel."""
    units: int
    points: int
    places: np.ndarray
    sentinel: bool


class Chunks:
    """Summaries by content."""

    def __init__(self, unit: str, sentinels, limit: int = CACHE_BYTES):
        self.unit, self.limit, self.size, self.known = unit, limit, 0, {}
        self.sentinels = [s.encode() for s in sentinels]
        self.pattern = re.compile(b"|".join(re.escape(s) for s in self.sentinels))
        self.reach = max(len(s) for s in self.sentinels) - 1
        self.found = self.asked = 0

    def summary(self, chunk: bytes) -> Summary:
        self.asked += 1
        known = self.known.get(chunk)
        if known is not None:
            self.found += 1
            return known
        raw = np.frombuffer(chunk, np.uint8)
        begins = (raw & 0xC0) != 0x80
        # a line ends behind its newline, a character before the next one begins
        places = np.flatnonzero(raw == 10) + 1 if self.unit == "line" else np.flatnonzero(begins)
        known = Summary(len(places), int(begins.sum()), places.astype(np.uint16), self.pattern.search(chunk) is not None)
        size = len(chunk) + known.places.nbytes + _ROW_BYTES
        if self.size + size > self.limit:
            self.known.clear()
            self.size = 0
        self.known[chunk] = known
        self.size += size
        return known


class Text:
    """A text as summaries of its chunks."""

    def __init__(self, raw: bytes, chunks: Chunks):
        self.raw, self.chunks = raw, chunks
        ends = chunk_ends(np.frombuffer(raw, np.uint8))
        self.starts = [0, *ends[:-1]] if ends else []
        self.parts = [chunks.summary(raw[a:b]) for a, b in zip(self.starts, ends)]
        self.units = np.cumsum([0] + [p.units for p in self.parts])
        self.points = np.cumsum([0] + [p.points for p in self.parts])
        reach = chunks.reach
        self.sentinel = any(p.sentinel for p in self.parts) or any(
            chunks.pattern.search(raw[max(0, a - reach):a + reach]) for a in self.starts[1:])

    @property
    def n(self) -> int:
        """Units: characters, or lines with the last one whether or not it ends."""
        whole = int(self.units[-1])
        return whole + (self.chunks.unit == "line" and len(self.raw) > 0 and self.raw[-1:] != b"\n")

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` units."""
        if k == 0:
            return 0, 0
        if k >= self.n:
            return len(self.raw), int(self.points[-1])
        # a line's end is the k-th place, a character's the place of the character that follows it
        order = k if self.chunks.unit == "line" else k + 1
        i = int(np.searchsorted(self.units, order)) - 1
        place = int(self.parts[i].places[order - int(self.units[i]) - 1])
        head = np.frombuffer(self.raw, np.uint8, place, self.starts[i]) if place else np.zeros(0, np.uint8)
        return self.starts[i] + place, int(self.points[i]) + int(((head & 0xC0) != 0x80).sum())


def numbers(key, seed: int) -> list[int]:
    """Four numbers of 32 bits from the seed and an id."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def rewritten(raw: bytes, key, chunks: Chunks, seed: int, rate: int, spm_rate: int):
    """(units, form, prefix's code points, middle's code points, output) of one text."""
    text = Text(raw, chunks)
    h1, h2, h3, h4 = numbers(key, seed)
    n = text.n
    if not raw or text.sentinel or h3 % 100 >= rate:
        return n, "plain", None, None, raw
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, points_a), (b, points_b) = text.cut(low), text.cut(high)
    p, s, m = chunks.sentinels
    prefix, middle, suffix = p + raw[:a], m + raw[a:b], s + raw[b:]
    spm = h4 % 100 < spm_rate
    return n, "spm" if spm else "psm", points_a, points_b - points_a, (suffix + prefix if spm else prefix + suffix) + middle


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50,
              unit: str = "line", sentinels=(PREFIX, SUFFIX, MIDDLE), carry=()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) and the columns named in ``carry``.

    ``rate`` of 100 texts are rewritten, ``spm_rate`` of 100 of these with the suffix first; ``unit``: ``line`` or ``char``.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit {unit!r}")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"),
                       *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])
    kept = [f"c{i}" for i in range(len(carry))]
    made = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        chunks = Chunks(unit, sentinels)
        for batch in batches:
            ids = batch.column("id").to_pylist()
            out = [rewritten(raw, key, chunks, seed, rate, spm_rate) for raw, key in zip(batch.column("text").to_pylist(), ids)]
            columns = [batch.column("id")] + [pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c) for c in kept], made + kept)

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {types['id']}, n long, form string, prefix_chars long, middle_chars long, output binary" + "".join(f", {c} {types[c]}" for c in kept)
    found = rows.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))
    return found.select(F.col("id").alias(id_col), *made[1:], *[F.col(k).alias(c) for k, c in zip(kept, carry)])


def restored(output, form, sentinels=(PREFIX, SUFFIX, MIDDLE)):
    """The text from an output and its form, as a column expression: a rewritten text holds no sentinel of its own."""
    p, s, m = sentinels
    between = lambda lead, end: F.substring_index(F.substring(output, F.lit(len(lead) + 1), F.length(output)), end, 1)
    middle = F.substring_index(output, m, -1)
    head = F.substring_index(output, m, 1)
    psm = F.concat(between(p, s), middle, F.substring_index(head, s, -1))
    spm = F.concat(F.substring_index(head, p, -1), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


SQL = r"""
with told as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
    sha256('7:' || coalesce(doc_id::varchar, 'None')) as h from documents),
numbered as (select *, len(u) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from told),
placed as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form from numbered),
cut as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from placed)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars,
  case when form <> 'plain' then length(m) end::bigint as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from cut
"""
