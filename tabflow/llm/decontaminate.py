"""Benchmark decontamination with an FM-index per training shard (operator 1).

The words of a run of documents (a shard of at most ``SHARD_SYMBOLS`` symbols)
are numbered by the benchmark's vocabulary and indexed: suffix array by prefix
doubling, Burrows-Wheeler transform, and a wavelet matrix with block ranks.  All
benchmark windows are searched backwards at once, one rank query per word; the
rows found are located by walking to the nearest sampled suffix position; the
occurrences are merged into removal spans of each document.

A word that no benchmark item holds cannot be inside an occurrence, so it ends a
stretch and is not indexed, nor is a stretch shorter than the shortest window.
Nothing else is left out.

Scale: no shuffle; each task indexes its own documents shard by shard with
bounded memory.  The benchmark is measured first and handled in blocks of about
``BLOCK_BYTES``; each block's windows are broadcast and one narrow pass per block
adds its spans, so a benchmark of any size works with bounded broadcasts.

Defined results: null and empty texts have no words; items without words have no
windows; an item given twice (same id) counts once; a null item id is written as
``null``; an empty benchmark marks nothing; repeated documents are judged one by
one.  Only id and text columns are read for the report; ``remove`` carries all
input columns through untouched but for the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import stored

WINDOW = 10
SHARD_SYMBOLS = 1 << 20
SHARD_ROWS = 20_000
SHARD_BYTES = 8 << 20         # texts held for removal
BLOCK_BYTES = 4 << 20
SAMPLE_EVERY = 8
SLICE_ROWS = 128

# byte -> lower-cased word byte, or a blank for ASCII that is neither digit nor letter
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
                   for b in range(256))
WORD = re.compile(rb"[^ ]+")


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


class WaveletMatrix:
    """rank and access over an integer sequence, one bit vector per level with block counts."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.size = len(seq)
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(np.uint8)
            padded = np.zeros((self.size // 64 + 1) * 64, np.uint8)
            padded[:self.size] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(ones)[:-1])))
            self.zeros.append(self.size - int(ones.sum()))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][at] + np.bitwise_count(self.words[level][at] & mask)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``i`` (both vectors)."""
        start, end = np.zeros_like(i), i
        for level in range(self.bits):
            bit = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            s1, e1 = self._ones(level, start), self._ones(level, end)
            start = np.where(bit, self.zeros[level] + s1, start - s1)
            end = np.where(bit, self.zeros[level] + e1, end - e1)
        return end - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at position ``i`` and its rank there."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for level in range(self.bits):
            bit = (self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)
            symbol = (symbol << 1) | bit.astype(np.int64)
            i1, s1 = self._ones(level, i), self._ones(level, start)
            i = np.where(bit == 1, self.zeros[level] + i1, i - i1)
            start = np.where(bit == 1, self.zeros[level] + s1, start - s1)
        return symbol, i - start


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix order of a sequence whose zeros end a stretch; a zero sorts below all symbols and zeros by position.

    Prefix doubling; only suffixes that still share their place with others are sorted again.
    """
    n = len(seq)
    ends = seq == 0
    first = np.where(ends, np.cumsum(ends) - 1, seq + int(ends.sum()))
    sa = np.argsort(first, kind="stable")
    key = first[sa]
    head = np.concatenate(([True], key[1:] != key[:-1]))
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    last = np.concatenate((head[1:], [True]))
    slots = np.nonzero(~(head & last))[0]        # places whose suffix is not yet unique
    step = 1
    while len(slots):
        suffix = sa[slots]
        # a suffix that is not unique has met no zero yet, so suffix + step stays inside the sequence
        key = rank[suffix] * n + rank[suffix + step]
        order = np.argsort(key, kind="stable")
        suffix, key = suffix[order], key[order]
        sa[slots] = suffix
        head = np.concatenate(([True], key[1:] != key[:-1]))
        start = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        rank[suffix] = start
        last = np.concatenate((head[1:], [True]))
        slots = slots[~(head & last)]
        step *= 2
    return sa


class FMIndex:
    """Count and locate patterns in a sequence of symbols 1..n_symbols-1 cut by zeros."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        sa = suffix_array(seq)
        self.tree = WaveletMatrix(seq[sa - 1], n_symbols)
        counts = np.bincount(seq, minlength=n_symbols)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        # sampled: every SAMPLE_EVERY-th position and every stretch start, so no walk crosses a zero
        sampled = (sa % SAMPLE_EVERY == 0) | (seq[sa - 1] == 0)
        self.sampled, self.sampled_before, self.samples = sampled, np.cumsum(sampled) - sampled, sa[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of patterns (rows x longest, padded at the end)."""
        symbol = patterns[np.arange(len(patterns)), lengths - 1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for back in range(2, patterns.shape[1] + 1):
            live = np.nonzero((lengths >= back) & (high > low))[0]
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - back]
            low[live] = self.first[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: step back until a sampled one."""
        found = np.empty(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            hit = self.sampled[at]
            found[open_[hit]] = self.samples[self.sampled_before[at[hit]]] + steps
            open_, at = open_[~hit], at[~hit]
            if len(at):
                symbol, rank = self.tree.access(at)
                at = self.first[symbol] + rank
            steps += 1
        return found


class Phrases:
    """The windows of one block of benchmark items over a vocabulary of their own."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocab = Vocabulary()
        rows, lengths, owners = [], [], []
        names = {}
        for name, raw in items:
            owner = names.setdefault(name, len(names))
            ids = [self.vocab.number(w) for w in words_of(raw)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                part = ids[at:at + window]
                rows.append(part + [0] * (window - len(part)))
                lengths.append(len(part))
                owners.append(owner)
        self.names = list(names)
        if not rows:
            self.patterns, self.shortest = np.zeros((0, window), np.int64), 0
            return
        self.patterns, which = np.unique(np.array(rows, np.int64), axis=0, return_inverse=True)
        self.lengths = np.count_nonzero(self.patterns, axis=1)
        self.shortest = int(self.lengths.min())
        pairs = np.unique(np.stack((which.ravel(), np.array(owners)), axis=1), axis=0)
        self.owner_start = np.searchsorted(pairs[:, 0], np.arange(len(self.patterns) + 1))
        self.owners = pairs[:, 1]

    def owners_of(self, pattern: int) -> np.ndarray:
        return self.owners[self.owner_start[pattern]:self.owner_start[pattern + 1]]


class Vocabulary(dict):
    """word -> number from 1; 0 for any other word."""

    def number(self, word: bytes) -> int:
        return self.setdefault(word, len(self) + 1)

    def __missing__(self, word):
        return 0


class Shard:
    """Documents gathered for one index."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.n_words: list[int] = []
        self.symbols, self.stretches, self.size = [], [], 0

    def add(self, texts: list[bytes]) -> None:
        """Keep the stretches of benchmark words that could hold a window."""
        vocab, parts, starts, at = self.phrases.vocab, [], [], 1
        first_doc = len(self.n_words)
        for raw in texts:
            found = words_of(raw)
            self.n_words.append(len(found))
            ids = np.fromiter(map(vocab.__getitem__, found), np.int32, len(found))
            parts.append(ids)
            starts.append(at)
            at += len(found) + 1
        if not self.phrases.shortest:
            return
        seq = np.zeros(at, np.int32)
        for start, ids in zip(starts, parts):
            seq[start:start + len(ids)] = ids
        inside = seq != 0
        edge = np.diff(inside.astype(np.int8))
        begin, end = np.nonzero(edge == 1)[0] + 1, np.nonzero(edge == -1)[0] + 1
        long = end - begin >= self.phrases.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return
        starts = np.array(starts)
        doc = np.searchsorted(starts, begin, "right") - 1
        # copy the stretches one after another, a zero after each
        size = end - begin
        out_start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
        total = int((size + 1).sum())
        source = np.arange(total) - np.repeat(out_start, size + 1) + np.repeat(begin, size + 1)
        self.symbols.append(seq[source].astype(np.int64))
        self.stretches.append(np.stack((out_start + self.size, doc + first_doc, begin - starts[doc]), axis=1))
        self.size += total

    def find(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """document -> (merged spans of word positions, item numbers) of all documents hit."""
        if not self.size:
            return {}
        seq, stretches = np.concatenate(self.symbols), np.concatenate(self.stretches)
        index = FMIndex(seq, len(self.phrases.vocab) + 1)
        low, high = index.search(self.phrases.patterns, self.phrases.lengths)
        hits = high - low
        if not hits.sum():
            return {}
        pattern = np.repeat(np.arange(len(hits)), hits)
        rows = np.arange(len(pattern)) - np.repeat(np.cumsum(hits) - hits, hits) + low[pattern]
        at = index.locate(rows)
        stretch = np.searchsorted(stretches[:, 0], at, "right") - 1
        doc = stretches[stretch, 1]
        start = at - stretches[stretch, 0] + stretches[stretch, 2]
        order = np.lexsort((start, doc))
        doc, start, pattern = doc[order], start[order], pattern[order]
        stop = start + self.phrases.lengths[pattern]
        cuts = np.concatenate(([0], np.nonzero(np.diff(doc))[0] + 1, [len(doc)]))
        return {int(doc[a]): (merge_spans(start[a:b], stop[a:b]), np.unique(np.concatenate(
            [self.phrases.owners_of(p) for p in np.unique(pattern[a:b])]))) for a, b in zip(cuts[:-1], cuts[1:])}


def merge_spans(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Union of spans sorted by start, as rows (start, stop)."""
    reach = np.maximum.accumulate(stop)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    return np.stack((start[new], reach[np.concatenate((new[1:], [True]))]), axis=1)


def find_all(phrases: Phrases, texts: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    shard = Shard(phrases)
    shard.add(texts)
    return shard.find()


def cut_out(raw: bytes, spans: np.ndarray) -> bytes:
    """The text without its spans of words; a blank stays in each place."""
    places = [m.span() for m in WORD.finditer(raw.translate(WORD_BYTES))]
    out, at = [], 0
    for first, stop in spans:
        out += [raw[at:places[first][0]], b" "]
        at = places[stop - 1][1]
    return b"".join(out) + raw[at:]


def clean_texts(phrases: Phrases, texts: list[bytes], found: dict) -> dict[int, bytes]:
    """document -> text without any window; repeated, as a cut may join words into a new occurrence."""
    cleaned: dict[int, bytes] = {}
    open_ = {doc: (texts[doc], spans) for doc, (spans, _) in found.items()}
    while open_:
        for doc, (raw, spans) in open_.items():
            cleaned[doc] = cut_out(raw, spans)
        docs = list(open_)
        again = find_all(phrases, [cleaned[d] for d in docs])
        open_ = {docs[i]: (cleaned[docs[i]], spans) for i, (spans, _) in again.items()}
    return cleaned


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of about ``block_bytes`` for broadcasting; its size is measured first."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"),
                            F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b) if n > 1 else rows
        yield [(r["id"], bytes(r["text"])) for r in part.collect()]


def _shards(batches, text_col: str, phrases: Phrases, hold_texts: bool):
    """Group the slices of a task's batches into shards: (slices, texts if held, shard)."""
    slices, texts, shard, held = [], [], Shard(phrases), 0
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            raws = [r or b"" for r in part.column(text_col).to_pylist()]
            shard.add(raws)
            if hold_texts:
                texts += raws
                held += sum(map(len, raws))
            else:
                part = part.drop_columns([text_col])
            slices.append(part)
            if shard.size >= SHARD_SYMBOLS or len(shard.n_words) >= SHARD_ROWS or held >= SHARD_BYTES:
                yield slices, texts, shard
                slices, texts, shard, held = [], [], Shard(phrases), 0
    if slices:
        yield slices, texts, shard


def _reporter(shared, window: int, keep_text: bool):
    """Arrow function that adds one block's spans to those found before."""
    def run(batches):
        phrases = Phrases(shared.value, window)
        for slices, _, shard in _shards(batches, "text", phrases, keep_text):
            found, doc = shard.find(), 0
            for part in slices:
                n = part.num_rows
                old = [part.column(c).to_pylist() if c in part.schema.names else [None] * n for c in ("edges", "items")]
                edges, items = [], []
                for i in range(n):
                    spans, owners = found.get(doc + i, (np.zeros((0, 2), np.int64), ()))
                    if old[0][i]:
                        both = np.concatenate((spans, np.array(old[0][i]).reshape(-1, 2)))
                        both = both[np.argsort(both[:, 0], kind="stable")]
                        spans = merge_spans(both[:, 0], both[:, 1])
                    edges.append(spans.ravel().tolist())
                    items.append((old[1][i] or []) + [phrases.names[o] for o in owners])
                columns = {"id": part.column("id"), **({"text": part.column("text")} if keep_text else {}),
                           "n_words": pa.array(shard.n_words[doc:doc + n], pa.int64()),
                           "edges": pa.array(edges, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
                doc += n
    return run


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, spans, items): merged hit spans as word positions [start, stop) and the ids of the
    items that have occurring windows, sorted as strings."""
    sc = docs.sparkSession.sparkContext
    state = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = state.schema["id"].dataType.simpleString()
    parts = list(blocks(benchmark, item_col, item_text_col, block_bytes))
    for i, block in enumerate(parts):
        more = i + 1 < len(parts)
        state = state.mapInArrow(_reporter(sc.broadcast(block), window, more), f"id {kind}, " + "text binary, " * more +
                                 "n_words bigint, edges array<bigint>, items array<string>")
    at = F.sequence(F.lit(1), F.size("edges"), F.lit(2))
    spans = F.when(F.size("edges") > 0, F.transform(at, lambda i: F.struct(
        F.element_at("edges", i).alias("start"), F.element_at("edges", i + 1).alias("stop")))).otherwise(
        F.array().cast("array<struct<start:bigint,stop:bigint>>"))
    return state.select(F.col("id").alias(id_col), "n_words", spans.alias("spans"),
                        F.array_sort(F.array_distinct("items")).alias("items"))


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns of ``docs``, the text without any occurring window.

    Each block of the benchmark is cut out in one narrow pass.  With several blocks a cut for one may join
    words into a window of another, so all blocks are passed again until a report finds nothing.
    """
    sc = docs.sparkSession.sparkContext
    parts = [sc.broadcast(b) for b in blocks(benchmark, item_col, item_text_col, block_bytes)]
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    text = inner[names.index(text_col)]
    state = docs.select(*[F.col(f"`{n}`").cast("string").cast("binary").alias(c) if n == text_col else F.col(f"`{n}`").alias(c)
                          for n, c in zip(names, inner)])
    schema = state.schema

    def remover(shared):
        def run(batches):
            phrases = Phrases(shared.value, window)
            for slices, texts, shard in _shards(batches, text, phrases, True):
                cleaned, doc = clean_texts(phrases, texts, shard.find()), 0
                for part in slices:
                    n = part.num_rows
                    if any(doc + i in cleaned for i in range(n)):
                        raws = [cleaned.get(doc + i, raw) for i, raw in enumerate(part.column(text).to_pylist())]
                        place = part.schema.get_field_index(text)
                        part = part.set_column(place, part.schema.field(place), pa.array(raws, part.schema.field(place).type))
                    yield part
                    doc += n
        return run

    while True:
        for shared in parts:
            state = state.mapInArrow(remover(shared), schema)
        if len(parts) == 1:
            break
        state = stored(state, "decontaminated")
        left = report(state.select(F.monotonically_increasing_id().alias("id"), F.decode(text, "UTF-8").alias("text")), benchmark,
                      "id", "text", item_col, item_text_col, window, block_bytes)
        if not left.where(F.size("spans") > 0).limit(1).count():
            break
    return state.select(*[F.decode(c, "UTF-8").alias(n) if c == text else F.col(c).alias(n) for n, c in zip(names, inner)])


# DuckDB SQL for the registered query.
SQL = r"""
with docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as gram
            from items, unnest(range(1, greatest(2, len(w) - 8))) as t(i) where len(w) > 0),
grams as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as gram
          from docs, (select distinct n from windows), unnest(range(1, len(w) - n + 2)) as t(i)),
hits as (select doc_id, i, g.n, item_id from grams g join windows using (n, gram)),
hit_words as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as t(p) group by doc_id),
hit_items as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
              from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
