"""Feature matrices packed in blocks of rows, the input of the tree learners.

Every feature is cut once at quantiles of all rows into at most ``BINS`` byte bins (a feature of fewer values has one bin per
value); rows are packed first, and the quantiles are counted over the packed values.  A block is one row of a written table: the bins of up to ``BLOCK_ROWS`` rows, feature by feature, with target, fold and, where
asked for, the raw values, each as one binary column.  A pass over the table is a vectorised loop over blocks; the table is
written once into the shared folder, so passes neither recompute the features nor depend on any executor's memory, and the place of
a row in its block is fixed: seeded draws per row (subsampling, bootstrap) are functions of the block and the place.
"""

from __future__ import annotations

import contextlib
import hashlib
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q
from tabflow.models import linear
from tabflow.session import scratch_path

BINS = 256
BLOCK_ROWS = 32_768
ACCURACY = 20_000
GROUP_BYTES = 8 << 20          # a row group of a written table, what a writer or a reader holds at once
FIRST_BITS, MORE_BITS = 20, 12


@dataclass
class Blocks:
    """The written table with what is known of it: cuts per feature and, per fold, rows, mean and centred square sum of the target."""
    table: DataFrame
    features: list[str]
    cuts: list[np.ndarray]
    folds: dict

    def training(self, held_out) -> tuple[float, float]:
        """(rows, mean target) without one fold."""
        rest = [s for f, s in self.folds.items() if f != held_out]
        n = sum(s[0] for s in rest)
        return n, sum(s[0] * s[1] for s in rest) / n if n else 0.0


def _ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; NaN is the largest, both zeros are one."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits ^ np.int64(-1 << 63)).view(np.uint64)


def _double(key: int) -> float:
    bits = np.uint64(key) ^ np.uint64(1 << 63) if key >> 63 else ~np.uint64(key)
    return float(np.array(bits, np.uint64).view(np.float64))


def _merged(cells, counts, lows, highs):
    """Runs of cells with their rows, lowest and highest numbers, one entry a cell in ascending order."""
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    return cells[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(lows[order], first), np.maximum.reduceat(highs[order], first)


def order_statistics(table: DataFrame, d: int, ranks, slack: int = 0) -> np.ndarray:
    """(features, ranks): the values at these ranks (from 1), from the raw blocks.

    Doubles in their order are cut by their upper bits, ``FIRST_BITS`` in a first pass and ``MORE_BITS`` more in each other, which counts only the
    cells that hold a rank still looked for; a cell of one value, or of at most ``slack`` rows, is cut no further.  Tasks send what they counted
    by cell, it meets by feature on executors and the driver sees one row per rank.
    """
    out = np.full((d, len(ranks)), np.nan)
    todo = {f: [(i, 0, int(r)) for i, r in enumerate(ranks)] for f in range(d)}     # place, upper bits, rank among the rows with these
    known = 0
    while todo:
        more = min(MORE_BITS if known else FIRST_BITS, 64 - known)
        shift = 64 - known - more
        told = table.sparkSession.sparkContext.broadcast({f: (np.array(sorted({u for _, u, _ in wants}), np.uint64), wants) for f, wants in todo.items()})

        def count(batches):
            sums = {}
            for batch in batches:
                for i in range(batch.num_rows):
                    x = np.frombuffer(batch.column("x")[i].as_buffer()).reshape(-1, batch.column("n")[i].as_py())
                    for f, (upper, _) in told.value.items():
                        keys = np.sort(_ordered(x[f]))
                        cells = keys >> np.uint64(shift)
                        first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
                        ends = np.concatenate((first[1:], [len(keys)]))
                        cells, lows, highs, n = cells[first], keys[first], keys[ends - 1], ends - first
                        if known:
                            of = cells >> np.uint64(more)
                            kept = upper[np.minimum(np.searchsorted(upper, of), len(upper) - 1)] == of
                            cells, lows, highs, n = cells[kept], lows[kept], highs[kept], n[kept]
                        parts = sums.setdefault(f, [])
                        parts.append((cells, n, lows, highs))
                        if len(parts) > 16:
                            sums[f] = [_merged(*map(np.concatenate, zip(*parts)))]
            for f, parts in sums.items():
                found = _merged(*map(np.concatenate, zip(*parts)))
                yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32())] + [pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in zip(found, _KINDS)],
                                                 ["f", "cells", "rows", "lows", "highs"])

        def choose(batches):
            sums = {}
            for batch in batches:
                for f, *raw in zip(*(batch.column(c).to_pylist() for c in ("f", "cells", "rows", "lows", "highs"))):
                    sums.setdefault(f, []).append([np.frombuffer(r, t) for r, t in zip(raw, _KINDS)])
            for f, parts in sums.items():
                cells, n, lows, highs = _merged(*map(np.concatenate, zip(*parts)))
                below, of = np.cumsum(n) - n, cells >> np.uint64(more) if more < 64 else np.zeros(len(cells), np.uint64)
                rows = []
                for i, u, rank in told.value[f][1]:
                    first = np.searchsorted(of, np.uint64(u))
                    at = int(np.searchsorted(below, below[first] + rank, side="left")) - 1
                    left = int(rank + below[first] - below[at])
                    # the last of a cell's rows is its highest, the first its lowest
                    value = highs[at] if left == n[at] or n[at] <= slack else lows[at] if left == 1 else highs[at]
                    done = left in (1, n[at]) or lows[at] == highs[at] or n[at] <= slack
                    rows.append((f, i, int(cells[at].astype(np.int64)), left, bool(done), int(value.astype(np.int64))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()))],
                                                 ["f", "place", "upper", "rank", "done", "value"])

        counted = table.select("n", "x").mapInArrow(count, "f int, cells binary, rows binary, lows binary, highs binary")
        rows = counted.repartition(len(todo), "f").mapInArrow(choose, "f int, place int, upper long, rank long, done boolean, value long").collect()
        told.unpersist()
        todo, known = {}, known + more
        for r in rows:
            if r["done"]:
                out[r["f"], r["place"]] = _double(r["value"] & 0xFFFFFFFFFFFFFFFF)
            else:
                todo.setdefault(r["f"], []).append((r["place"], r["upper"] & 0xFFFFFFFFFFFFFFFF, r["rank"]))
    return out


_KINDS = (np.uint64, np.int64, np.uint64, np.uint64)


def feature_cuts(table: DataFrame, d: int, n: int, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the values at which it is cut (a row lies in the bin of the first cut that is not below it): quantiles of
    all ``n`` rows of the raw blocks, at most ``bins - 1``, no further off than ``n / ACCURACY`` ranks."""
    if not d or not n:
        return [np.zeros(0)] * d
    ranks = [max(1, math.ceil(i / bins * n)) for i in range(bins)] + [n]
    out = []
    for x in order_statistics(table, d, ranks, n // ACCURACY):
        values = np.unique(x[:-1])
        out.append(values[values < x[-1]][-(bins - 1):])
    return out


def binned(x: np.ndarray, cuts) -> np.ndarray:
    """(features, rows) of byte bins."""
    return np.stack([np.searchsorted(c, v, side="left").astype(np.uint8) for c, v in zip(cuts, x)]) if len(cuts) else np.zeros((0, x.shape[1]), np.uint8)


def pack(df: DataFrame, features, target: str, fold_col=None, bins: int = BINS, raw: bool = False, on_null: str = "error"):
    """Cut, pack and write a modelling table; null features or targets fail with their count unless ``on_null="drop"``.  Of several
    fold columns: one :class:`Blocks` each over the same written table."""
    features = list(features)
    fold_cols = [fold_col] if fold_col is None or isinstance(fold_col, str) else list(fold_col)
    folds = [f"fold{i}" if i else "fold" for i in range(len(fold_cols))]
    rows = linear.complete_rows(df, features, target, on_null).select(
        *[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], q(target).cast("double").alias("y"),
        *[(q(c).cast("int") if c else F.lit(0)).alias(f) for c, f in zip(fold_cols, folds)])
    names = [f"x{i}" for i in range(len(features))]
    bad = F.count_if(reduce(lambda a, b: a | b, [q(c).isNull() for c in [*names, "y"]]) if names else F.lit(False))
    stats = rows.groupBy(*folds).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("m"), F.var_pop("y").alias("v"), bad.alias("bad")).collect()
    if wrong := sum(r["bad"] for r in stats):
        raise ValueError(f"{wrong} rows have a null feature or target; fill them or pass on_null='drop'")
    n_rows = sum(r["n"] for r in stats)

    def run(batches):
        held, n = [], 0

        def block():
            data = [np.concatenate([h[i] for h in held], axis=-1) for i in range(2 + len(folds))]
            values = [data[1].size, data[0].tobytes(), data[1].tobytes()] + [f.astype(np.int32).tobytes() for f in data[2:]]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if i else pa.int64()) for i, v in enumerate(values)], ["n", "x", "y", *folds])

        for batch in batches:
            held.append([linear._matrix(batch, names).T if names else np.zeros((0, batch.num_rows)),
                         *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", *folds)]])
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block()
                held, n = [], 0
        if n:
            yield block()

    # a task fills one block at least
    whole = rows.coalesce(max(1, -(-n_rows // BLOCK_ROWS)))
    values = _written(whole.mapInArrow(run, "n long, x binary, y binary, " + ", ".join(f"{f} binary" for f in folds)), "raw-blocks")
    cuts = feature_cuts(values, len(features), n_rows, bins)

    def cut(batches):
        kept = ["n", "y", *folds] + (["x"] if raw else [])
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("x")[i].as_buffer()).reshape(-1, batch.column("n")[i].as_py())
                b = binned(x, cuts).tobytes()
                label = int.from_bytes(hashlib.blake2b(b + batch.column("y")[i].as_py(), digest_size=8).digest(), "little", signed=True)
                yield pa.RecordBatch.from_arrays([pa.array([label], pa.int64()), pa.array([b], pa.binary())] + [batch.column(c).slice(i, 1) for c in kept],
                                                 ["block", "bins", *kept])

    table = _written(values.mapInArrow(cut, "block long, bins binary, n long, y binary, " + ", ".join(f"{f} binary" for f in folds)
                                       + (", x binary" if raw else "")), "blocks")
    discard(values)
    packed = []
    for f in folds:
        parts = {}
        for r in stats:
            parts.setdefault(r[f], []).append((r["n"], r["m"], r["n"] * r["v"]))
        plain = table.select("block", "n", "bins", "y", F.col(f).alias("fold"), *(["x"] if raw else []))
        packed.append(Blocks(plain, features, cuts, {k: _together(p) for k, p in parts.items()}))
    return packed[0] if fold_col is None or isinstance(fold_col, str) else packed


class Packs:
    """A modelling table's blocks for several cross-validations, packed once for each kind of bins and all fold columns together.
    ``once``: the table is not read after that, and need not be held by executors while trees grow."""

    def __init__(self, df: DataFrame, features, target: str, fold_cols, on_null: str = "error", once: bool = False):
        self.df, self.features, self.target, self.fold_cols, self.on_null, self.once = df, features, target, list(dict.fromkeys(fold_cols)), on_null, once
        self.held = {}

    @classmethod
    def of(cls, packs, df: DataFrame, features, target: str, fold_col: str, on_null: str):
        """The given ones, which their owner closes, or own ones."""
        return contextlib.nullcontext(packs) if packs is not None else cls(df, features, target, [fold_col], on_null)

    def get(self, fold_col: str, bins: int = BINS, raw: bool = False) -> Blocks:
        if (bins, raw) not in self.held:
            self.held[bins, raw] = pack(self.df, self.features, self.target, self.fold_cols, bins, raw, self.on_null)
            if self.once:
                self.df.unpersist()
        return self.held[bins, raw][self.fold_cols.index(fold_col)]

    def __enter__(self):
        return self

    def __exit__(self, *_):
        for packed in self.held.values():
            discard(packed[0].table)
        self.held = {}


def _together(parts) -> tuple:
    """Rows, mean and centred square sum of several groups."""
    if len(parts) == 1:
        return parts[0]
    n = sum(p[0] for p in parts)
    mean = math.fsum(p[0] * p[1] for p in parts) / n
    return n, mean, math.fsum(p[2] + p[0] * (p[1] - mean) ** 2 for p in parts)


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table of blocks, in row groups of ``GROUP_BYTES`` or one block.  Parquet measures its pages and row groups every hundred rows only, which are
    hundreds of MB of blocks: on both sides a task would hold them several times over, in the heap and in the codec's buffers beside it."""
    path = scratch_path(df.sparkSession, name)
    sizes = {"parquet.block.size": GROUP_BYTES, "parquet.enable.dictionary": "false"}
    sizes |= {f"parquet.{kind}.size.row.check.{end}": 1 for kind in ("block", "page") for end in ("min", "max")}
    df.write.options(**sizes).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a written table that no pass reads any more."""
    jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def unpacked(batch, i: int) -> dict:
    """The arrays of one block: bins (features, rows), y, fold, the raw values where they were kept."""
    n = batch.column("n")[i].as_py()
    take = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
    out = {"n": n, "block": batch.column("block")[i].as_py(), "bins": take("bins", np.uint8).reshape(-1, n), "y": take("y", float),
           "fold": take("fold", np.int32)}
    if "x" in batch.schema.names:
        out["x"] = take("x", float).reshape(-1, n)
    if "margins" in batch.schema.names:
        out["margins"] = take("margins", float).reshape(-1, n)
    return out


def uniform(block: int, n: int, *seeds: int) -> np.ndarray:
    """Seeded numbers in [0, 1), one per place of a block."""
    with np.errstate(over="ignore"):
        x = np.arange(n, dtype=np.uint64) + np.uint64(block & 0xFFFFFFFFFFFFFFFF)
        for s in seeds:
            x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)
