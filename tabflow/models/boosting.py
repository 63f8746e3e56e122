"""Second-order gradient boosting on distributed histograms, grown in three ways.

``depth``      level by level, every node with a positive gain (roles of the reference's first booster)
``leaf``       best leaf first, up to ``num_leaves``; a split's smaller child is counted, its sibling is the parent less it
``symmetric``  one split a level for all leaves, so that a tree scores as one look-up by the bits of its tests

Data lie in :mod:`blocks`: every feature is cut once into byte bins.  A pass over the blocks sums, for every wanted
node of every model being trained, gradients and rows by (feature, bin); partial sums are added on executors by node, the
driver sees one histogram per node.  Many models (settings and folds of a search) grow in the same passes, each at
its own round and level, so the number of Spark jobs does not grow with them.  A pass asks for at most ``HISTOGRAM_BYTES``
of histograms at a time, whatever the depth and the number of features; the memory of a task is one block and its sums.

Squared error: gradient ``F - y``, hessian 1 a row, so a child's weight is its number of rows.  With G and H the sums of a node,
T(G) = sign(G) max(|G| - reg_alpha, 0):

  leaf value  -T(G) / (H + reg_lambda)
  gain        (T(GL)^2 / (HL + reg_lambda) + T(GR)^2 / (HR + reg_lambda) - T(G)^2 / (H + reg_lambda)) / 2 - gamma

A split needs a positive gain and ``min_child`` rows on both sides; in a symmetric tree a leaf whose children would be
smaller adds nothing to its level's gain.  Ties: the first feature, then the lowest cut; of leaves the one made first.

Predictions of finished trees are added to the blocks every ``REFRESH`` rounds by writing the table anew (the lineage
of a pass is one scan); between that, a pass walks the few trees since.  All models grow a round together, so that a pass
hardly ever walks a finished tree.  Row and column samples are seeded by tree.
"""

from __future__ import annotations

import heapq
import json
import math
import os
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import q
from tabflow.models import blocks as B

GROWTHS = ("depth", "leaf", "symmetric")
HISTOGRAM_BYTES = 64 << 20
SUM_BYTES = 8 << 20
SEEN_BYTES = 64 << 20
REFRESH = 1
AT_ONCE = 32      # models in training: a block carries a prediction of each


@dataclass(frozen=True)
class BoostParams:
    growth: str = "depth"
    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 6
    num_leaves: int = 31
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child: float = 1.0
    seed: int = 42

    def __post_init__(self):
        if self.growth not in GROWTHS:
            raise ValueError(f"growth is one of {GROWTHS}, not {self.growth!r}")
        if self.growth == "symmetric" and self.max_depth > 16:
            raise ValueError("a symmetric tree has a depth of 16 at most")


# The vendors' names of the same parameters.
PARAM_NAMES = {"n_estimators": "rounds", "iterations": "rounds", "depth": "max_depth", "l2_leaf_reg": "reg_lambda",
               "min_child_weight": "min_child", "min_child_samples": "min_child", "min_data_in_leaf": "min_child"}


def boost_params(growth: str, params: dict) -> BoostParams:
    """Parameters by this module's or the vendors' names."""
    return BoostParams(growth, **{PARAM_NAMES.get(k, k): v for k, v in params.items()})


@dataclass
class Tree:
    """Nodes by number, 0 the root: the test ``bin of feature <= cut`` (feature -1: a leaf), children, value, gain and rows."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])
    rows: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node], self.gain[node] = feature, cut, a, a + 1, gain
        for column, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0), (self.rows, 0.0)):
            column += [empty, empty]
        return a, a + 1

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        return walk(bins, *(np.array(c) for c in (self.feature, self.cut, self.left, self.right)))


def walk(bins, feature, cut, left, right) -> np.ndarray:
    """The leaf of every row: all rows take a step a level (a leaf leads to itself) while most are on their way, then those only."""
    n = bins.shape[1]
    node = np.zeros(n, np.int64)
    inner = feature >= 0
    if not inner[0] or not n:
        return node
    flat, at = np.ascontiguousarray(bins).reshape(-1), np.arange(n)
    start = np.where(inner, feature, 0) * n
    own = np.arange(len(feature))
    child = np.stack((np.where(inner, right, own), np.where(inner, left, own)), axis=1).reshape(-1)
    here, rows = node, None
    while True:
        goes_left = flat.take(start.take(here) + at) <= cut.take(here)
        here = child.take(2 * here + goes_left)
        more = inner.take(here)
        left_over = np.count_nonzero(more)
        if left_over * 2 > len(here):
            continue
        # the others have arrived
        if rows is None:
            rows = at
        node[rows] = here
        if not left_over:
            return node
        go = np.flatnonzero(more)
        rows, here, at = rows[go], here[go], at[go]


def _score(g, h, p: BoostParams):
    kept = np.maximum(np.abs(g) - p.reg_alpha, 0)
    return kept * kept / np.maximum(h + p.reg_lambda, 1e-12)


def leaf_value(g: float, h: float, p: BoostParams) -> float:
    return -math.copysign(max(abs(g) - p.reg_alpha, 0), g) / max(h + p.reg_lambda, 1e-12)


def split_gains(hist: np.ndarray, p: BoostParams, columns) -> tuple[np.ndarray, np.ndarray]:
    """Of a node's (2, features, bins) sums: the gain of every cut, and rows left of it; forbidden cuts are -inf."""
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    total = hist.sum(axis=2)[:, :, None]
    right = total - left
    gain = (_score(*left, p) + _score(*right, p) - _score(*total, p)) / 2 - p.gamma
    allowed = (left[1] >= max(p.min_child, 1)) & (right[1] >= max(p.min_child, 1))
    mask = np.zeros(hist.shape[1], bool)
    mask[columns] = True
    return np.where(allowed & mask[:, None], gain, -np.inf), left[1]


def best_split(hist: np.ndarray, p: BoostParams, columns):
    """(gain, feature, cut, rows left), or None without a positive gain."""
    if hist.shape[1] == 0 or hist.shape[2] < 2:
        return None
    gain, left = split_gains(hist, p, columns)
    at = int(np.argmax(gain))
    f, c = divmod(at, gain.shape[1])
    return (float(gain[f, c]), f, c, float(left[f, c])) if gain[f, c] > 1e-12 else None


def _sample(d: int, share: float, *seeds) -> np.ndarray:
    k = max(1, math.ceil(share * d)) if d else 0
    return np.arange(d) if k >= d else np.sort(np.random.default_rng(seeds).permutation(d)[:k])


class Grower:
    """One model in training: what it wants counted next, and what it does with the counts.

    A want is (node, feature, cut, side): a node whole (feature -1), or one side of a test that would split it.
    """

    def __init__(self, params: BoostParams, d: int, base: float, held_out=None):
        if d < 1:
            raise ValueError("a tree needs at least one feature")
        self.p, self.d, self.base, self.held_out = params, d, base, held_out
        self.trees: list[Tree] = []
        self._begin()

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.p.rounds

    def _begin(self):
        self.tree, self.level, self.got, self.queue = Tree(), 0, {}, []
        self.columns = _sample(self.d, self.p.colsample_bytree, self.p.seed, len(self.trees), 1)
        self.wanted = [(0, -1, 0, True)]

    def _level_columns(self, level: int):
        at = _sample(len(self.columns), self.p.colsample_bylevel, self.p.seed, len(self.trees), 2, level)
        return self.columns[at]

    def take(self, counts: dict) -> None:
        """Histograms of wants; the tree grows on when all it waits for are there."""
        self.got.update(counts)
        if all(w in self.got for w in self.wanted):
            {"depth": self._by_depth, "leaf": self._by_leaf, "symmetric": self._by_level}[self.p.growth]()

    def _leaf(self, node: int, hist: np.ndarray):
        g, h = hist[:, self.columns[0]].sum(axis=1)
        self.tree.value[node], self.tree.rows[node] = leaf_value(float(g), float(h), self.p), float(h)

    def _children(self, node: int, hist: np.ndarray, f: int, c: int, gain: float) -> list[tuple[int, float]]:
        """Split a node: its children with their rows; their sums lie in the parent's histogram."""
        out = []
        for child, side in zip(self.tree.split(node, f, c, gain), (hist[:, f, :c + 1], hist[:, f, c + 1:])):
            g, h = map(float, side.sum(axis=1))
            self.tree.value[child], self.tree.rows[child] = leaf_value(g, h, self.p), h
            out.append((child, h))
        return out

    def _finish(self):
        self.tree.value = [v * self.p.learning_rate for v in self.tree.value]
        self.trees.append(self.tree)
        self._begin()

    def _by_depth(self):
        following = []
        for want in self.wanted:
            node, hist = want[0], self.got.pop(want)
            self._leaf(node, hist)
            found = best_split(hist, self.p, self._level_columns(self.level)) if self.level < self.p.max_depth else None
            if found:
                gain, f, c, _ = found
                # children that cannot be split are counted no more
                following += [(child, -1, 0, True) for child, h in self._children(node, hist, f, c, gain)
                              if self.level + 1 < self.p.max_depth and h >= 2 * max(self.p.min_child, 1)]
        self.wanted, self.level = following, self.level + 1
        if not following:
            self._finish()

    def _by_level(self):
        hists = {w[0]: self.got.pop(w) for w in self.wanted}
        total = 0
        for node, hist in hists.items():
            self._leaf(node, hist)
            gain, _ = split_gains(hist, self.p, self._level_columns(self.level))
            total = total + np.where(np.isfinite(gain), gain, 0)
        if self.level >= self.p.max_depth or total.max() <= 1e-12:
            self._finish()
            return
        f, c = divmod(int(np.argmax(total)), total.shape[1])
        children = [n for node in sorted(hists) for n, _ in self._children(node, hists[node], f, c, float(total[f, c]) / len(hists))]
        self.wanted, self.level = [(n, -1, 0, True) for n in children], self.level + 1
        if self.level >= self.p.max_depth:
            self._finish()

    def _push(self, node: int, hist: np.ndarray, level: int):
        self._leaf(node, hist)
        found = best_split(hist, self.p, self._level_columns(level)) if level < self.p.max_depth else None
        if found:
            gain, f, c, left = found
            # the side with fewer rows is counted
            side = (node, f, c, left * 2 <= self.tree.rows[node])
            heapq.heappush(self.queue, (-gain, node, level, side, hist))

    def _by_leaf(self):
        """Splits the best leaves whose smaller side is counted; then wants the smaller sides of the best others: whatever is
        split next is among them or below them."""
        if not self.queue and (0, -1, 0, True) in self.got:
            self._push(0, self.got.pop((0, -1, 0, True)), 0)
        leaves = (len(self.tree.feature) + 1) // 2
        while self.queue and leaves < self.p.num_leaves and self.queue[0][3] in self.got:
            gain, node, level, side, hist = heapq.heappop(self.queue)
            small = self.got.pop(side)
            a, b = self.tree.split(node, side[1], side[2], -gain)
            for child, part in zip((a, b), (small, hist - small) if side[3] else (hist - small, small)):
                self._push(child, part, level + 1)
            leaves += 1
        if not self.queue or leaves >= self.p.num_leaves:
            self._finish()
            return
        best = heapq.nsmallest(self.p.num_leaves - leaves, self.queue)
        self.wanted = [e[3] for e in best if e[3] not in self.got]


def _arrays(tree: Tree):
    return tuple(np.array(c) for c in (tree.feature, tree.cut, tree.left, tree.right, tree.value))


_SEEN: OrderedDict = OrderedDict()


def _margins(block: dict, run: str, at: int, base: float, trees) -> np.ndarray:
    """Predictions of one model: those written with the block, and trees since.  A worker remembers what it has added up for a
    block (at most ``SEEN_BYTES``), so a later pass adds only newer trees; without that they are added up again."""
    if not trees:
        return block["margins"][at] if "margins" in block else np.full(block["n"], base)
    key = (run, block["block"], at)
    done, out = _SEEN.pop(key, (0, None))
    if out is None:
        out = block["margins"][at].copy() if "margins" in block else np.full(block["n"], base)
    if done < len(trees):
        out = out.copy()
        for feature, cut, left, right, value in trees[done:]:
            out += value[walk(block["bins"], feature, cut, left, right)]
    _SEEN[key] = len(trees), out
    while len(_SEEN) > 1 and sum(o.nbytes for _, o in _SEEN.values()) > SEEN_BYTES:
        _SEEN.popitem(last=False)
    return out


def _count_pass(table: DataFrame, work: list, cuts, parallel: int, run_id: str) -> dict:
    """{(model, want): (2, features, bins) sums} of the wants of ``work``: rows (model, grower, trees since, wants)."""
    # a histogram travels as the bins that features really have, one feature after another
    at_feature = np.concatenate(([0], np.cumsum([len(c) + 1 for c in cuts])))
    width, d = int(at_feature[-1]), len(cuts)
    told = [(at, g.base, g.held_out, [_arrays(t) for t in since], _arrays(g.tree), wants, g.columns, g.p.subsample, (g.p.seed, len(g.trees), 3))
            for at, g, since, wants in work]
    shared = table.sparkSession.sparkContext.broadcast(told)

    def run(batches):
        sums = [np.zeros((2, len(m[5]), width)) for m in shared.value]
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                for (at, base, held_out, trees, current, wants, columns, share, seeds), total in zip(shared.value, sums):
                    slots = np.full(len(current[0]), -1)
                    tests = np.full((3, len(current[0])), -1)
                    for n, (node, f, c, side) in enumerate(wants):
                        slots[node], tests[:, node] = n, (f, c, side)
                    leaf = walk(block["bins"], *current[:4])
                    use = slots[leaf] >= 0
                    if held_out is not None:
                        use &= block["fold"] != held_out
                    if share < 1:
                        use &= B.uniform(block["block"], block["n"], *seeds) < share
                    rows = np.flatnonzero(use)
                    if (tests[0] >= 0).any():
                        f, c, side = tests[:, leaf[rows]]
                        rows = rows[(f < 0) | ((block["bins"][f, rows] <= c) == (side > 0))]
                    slot = slots.take(leaf.take(rows))
                    g = (_margins(block, run_id, at, base, trees) - block["y"]).take(rows)
                    for f in columns:
                        a, b = at_feature[f], at_feature[f + 1]
                        place = slot * (b - a) + block["bins"][f].take(rows)
                        total[0, :, a:b] += np.bincount(place, g, len(wants) * (b - a)).reshape(-1, b - a)
                        total[1, :, a:b] += np.bincount(place, minlength=len(wants) * (b - a)).reshape(-1, b - a)
        yield _hist_rows({(m, n): total[:, n] for m, total in enumerate(sums) for n in range(total.shape[1]) if total[1, n].any()})

    def add(batches):
        sums = {}
        for batch in batches:
            for m, n, raw in zip(*(batch.column(c).to_pylist() for c in ("model", "want", "hist"))):
                h = np.frombuffer(raw)
                sums[m, n] = sums[m, n] + h if (m, n) in sums else h
        yield _hist_rows(sums)

    parts = table.mapInArrow(run, _HIST)
    size = sum(len(w[3]) for w in work) * 2 * width * 8
    if parallel * size > SUM_BYTES:
        # partial sums meet by node, about SUM_BYTES of nodes a task; a few small ones are added up by the driver
        parts = parts.repartition(max(1, size // SUM_BYTES), "model", "want").mapInArrow(add, _HIST)
    sums = {}
    for r in parts.collect():
        key = work[r["model"]][0], work[r["model"]][3][r["want"]]
        h = np.frombuffer(r["hist"])
        sums[key] = sums[key] + h if key in sums else h
    shared.unpersist()
    out = {}
    for at, _, _, wants in work:
        for w in wants:
            out[at, w] = np.zeros((2, d, B.BINS))
            if (at, w) in sums:
                flat = sums[at, w].reshape(2, width)
                for f, (a, b) in enumerate(zip(at_feature, at_feature[1:])):
                    out[at, w][:, f, :b - a] = flat[:, a:b]
    return out


_HIST = "model int, want int, hist binary"


def _hist_rows(hists: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([m for m, _ in hists], pa.int32()), pa.array([n for _, n in hists], pa.int32()),
                                       pa.array([np.ascontiguousarray(h).tobytes() for h in hists.values()], pa.binary())], ["model", "want", "hist"])


def _refreshed(table: DataFrame, bases, since, run_id: str) -> DataFrame:
    """The blocks with every model's predictions so far, written anew."""
    told = table.sparkSession.sparkContext.broadcast([(b, [_arrays(t) for t in trees]) for b, trees in zip(bases, since)])
    plain = [f for f in table.schema.names if f != "margins"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                m = np.stack([_margins(block, run_id, at, base, trees) for at, (base, trees) in enumerate(told.value)])
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, 1) for c in plain] + [pa.array([m.tobytes()], pa.binary())], plain + ["margins"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema if f.name != "margins") + ", margins binary"
    return B._written(table.mapInArrow(run, schema), "margins")


@dataclass
class Fitted:
    """Trees of one model over binned features, with the error sums of its held-out fold."""
    params: BoostParams
    base: float
    trees: list
    held_out: object = None
    metrics: tuple | None = None


def train(packed: B.Blocks, jobs, refresh: int = REFRESH, histogram_bytes: int = HISTOGRAM_BYTES, keep_trees: bool = True) -> list[Fitted]:
    """Models (params, held-out fold or None) trained together, ``AT_ONCE`` at a time; those with a held-out fold are scored on it.
    Without ``keep_trees`` the driver forgets trees whose predictions are written with the blocks (None stands for each)."""
    jobs = list(jobs)
    if len(jobs) > AT_ONCE:
        return [m for a in range(0, len(jobs), AT_ONCE) for m in train(packed, jobs[a:a + AT_ONCE], refresh, histogram_bytes, keep_trees)]
    d = len(packed.features)
    growers = [Grower(p, d, packed.training(f)[1], f) for p, f in jobs]
    written, table = [0] * len(growers), packed.table
    parallel, run_id = table.rdd.getNumPartitions(), os.urandom(8).hex()
    room = max(1, histogram_bytes // (2 * max(d, 1) * B.BINS * 8))
    while not all(g.done for g in growers):
        # no model is ahead of another by more than the trees between two writings
        work, left, last = [], room, min(len(g.trees) for g in growers if not g.done)
        for at, g in enumerate(growers):
            wants = [w for w in g.wanted if w not in g.got][:left]
            if not g.done and len(g.trees) < last + refresh and wants:
                work.append((at, g, g.trees[written[at]:], wants))
                left -= len(wants)
            if left <= 0:
                break
        counted = _count_pass(table, work, packed.cuts, parallel, run_id)
        for at, g, _, wants in work:
            g.take({w: counted[at, w] for w in wants})
        since = [len(g.trees) - w for g, w in zip(growers, written) if not g.done]
        if since and min(since) >= refresh:
            table, old = _refreshed(table, [g.base for g in growers], [g.trees[w:] for g, w in zip(growers, written)], run_id), table
            run_id = os.urandom(8).hex()
            written, parallel = [len(g.trees) for g in growers], table.rdd.getNumPartitions()
            if not keep_trees:
                for g in growers:
                    g.trees = [None] * len(g.trees)
            if old is not packed.table:
                B.discard(old)
    out = [Fitted(g.p, g.base, g.trees, g.held_out) for g in growers]
    if any(g.held_out is not None for g in growers):
        _score_held_out(packed, table, out, written, run_id)
    if table is not packed.table:
        B.discard(table)
    return out


def _score_held_out(packed: B.Blocks, table: DataFrame, fitted: list[Fitted], written, run_id: str) -> None:
    told = table.sparkSession.sparkContext.broadcast(
        [(at, f.base, f.held_out, [_arrays(t) for t in f.trees[w:]]) for at, (f, w) in enumerate(zip(fitted, written)) if f.held_out is not None])

    def run(batches):
        sums = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                for at, base, held_out, trees in told.value:
                    rows = block["fold"] == held_out
                    e = (_margins(block, run_id, at, base, trees) - block["y"])[rows]
                    sums[at] = sums.get(at, 0) + np.array([rows.sum(), (e * e).sum(), np.abs(e).sum()])
        names = ["model", "n", "sse", "sae"]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32())] + [pa.array([s[k] for s in sums.values()], pa.float64()) for k in range(3)], names)

    parts = table.mapInArrow(run, "model int, n double, sse double, sae double")
    for r in parts.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("n", "sse", "sae")]).collect():
        sst = packed.folds[fitted[r["model"]].held_out][2]
        r2 = 1 - r["sse"] / sst if sst > 0 else float(r["sse"] == 0)
        if r["n"]:
            fitted[r["model"]].metrics = (int(r["n"]), math.sqrt(r["sse"] / r["n"]), r["sae"] / r["n"], r2)


class _TreeParams(Params):
    featureCols = Param(Params._dummy(), "featureCols", "features in order", typeConverter=TypeConverters.toListString)
    predictionCol = Param(Params._dummy(), "predictionCol", "output column", typeConverter=TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "nodes of every tree as JSON", typeConverter=TypeConverters.toString)
    base = Param(Params._dummy(), "base", "prediction without trees", typeConverter=TypeConverters.toFloat)
    combine = Param(Params._dummy(), "combine", "sum or mean of the trees", typeConverter=TypeConverters.toString)
    symmetric = Param(Params._dummy(), "symmetric", "all trees are symmetric", typeConverter=TypeConverters.toBoolean)


class TreesModel(Model, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Trees over raw features (``x <= threshold`` goes left).  Symmetric trees score as one look-up each, by the bits of their tests, in a
    column expression; others in vectorised batches."""

    def __init__(self, features=None, trees=None, base: float = 0.0, prediction_col: str = "prediction", combine: str = "sum", symmetric: bool = False):
        super().__init__()
        self._setDefault(featureCols=[], predictionCol="prediction", trees="[]", base=0.0, combine="sum", symmetric=False)
        self._set(featureCols=list(features or []), trees=json.dumps(trees or []), base=float(base), predictionCol=prediction_col,
                  combine=combine, symmetric=symmetric)

    def node_lists(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.trees))

    def _transform(self, df: DataFrame) -> DataFrame:
        features, out = self.getOrDefault(self.featureCols), self.getOrDefault(self.predictionCol)
        trees, base = self.node_lists(), self.getOrDefault(self.base)
        scale = 1 / max(1, len(trees)) if self.getOrDefault(self.combine) == "mean" else 1.0
        if not trees:
            return df.withColumn(out, F.lit(base))
        if self.getOrDefault(self.symmetric):
            terms = F.array(*[_lookup(features, t) for t in trees])
            return df.withColumn(out, F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) * F.lit(scale) + F.lit(base))
        packed = [tuple(np.array(t[k]) for k in ("feature", "threshold", "left", "right", "value")) for t in trees]
        shared = df.sparkSession.sparkContext.broadcast(packed)

        @F.pandas_udf("double")
        def predict(x: pd.DataFrame) -> pd.Series:
            values = np.ascontiguousarray(x.to_numpy(float).T)
            total = np.zeros(values.shape[1])
            for feature, threshold, left, right, value in shared.value:
                total += value[walk(values, feature, threshold, left, right)]
            bad = np.isnan(values).any(axis=0)
            return pd.Series(np.where(bad, np.nan, total * scale + base)).where(~bad, None)

        return df.withColumn(out, predict(F.struct(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])))

    @property
    def featureImportances(self):
        """Gain by feature, normalized to 1."""
        from pyspark.ml.linalg import DenseVector
        total = np.zeros(len(self.getOrDefault(self.featureCols)))
        for t in self.node_lists():
            for f, gain in zip(t["feature"], t["gain"]):
                if f >= 0:
                    total[f] += gain
        return DenseVector(total / (total.sum() or 1.0))


def _lookup(features, tree: dict):
    """A symmetric tree's value by the bits of its tests."""
    tests, nodes = [], [0]
    while tree["feature"][nodes[0]] >= 0:
        tests.append((features[tree["feature"][nodes[0]]], tree["threshold"][nodes[0]]))
        nodes = [c for n in nodes for c in (tree["left"][n], tree["right"][n])]
    place = F.lit(0)
    for feature, threshold in tests:
        x = q(feature).cast("double")
        # a null feature has no value
        place = place * 2 + F.when(x <= F.lit(threshold), 0).when(x.isNotNull(), 1)
    return F.get(F.array(*[F.lit(float(tree["value"][n])) for n in nodes]), place)


def named_trees(trees, cuts) -> list[dict]:
    """Trees over bins as trees over values."""
    return [{"feature": [int(f) for f in t.feature], "left": t.left, "right": t.right, "value": [float(v) for v in t.value],
             "gain": [float(g) for g in t.gain], "rows": [float(r) for r in t.rows],
             "threshold": [float(cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]} for t in trees]


def model_of(packed: B.Blocks, fitted: Fitted, prediction_col: str = "prediction") -> TreesModel:
    return TreesModel(packed.features, named_trees(fitted.trees, packed.cuts), fitted.base, prediction_col, "sum", fitted.params.growth == "symmetric")


def fit(df: DataFrame, features, target: str, params: BoostParams, prediction_col: str = "prediction", on_null: str = "error") -> TreesModel:
    """One model on all rows."""
    packed = B.pack(df, features, target, on_null=on_null)
    try:
        return model_of(packed, train(packed, [(params, None)])[0], prediction_col)
    finally:
        B.discard(packed.table)


def node_table(spark, models: dict) -> DataFrame:
    """(model, tree, node, feature, threshold, gain, rows, value, leaf) of :class:`TreesModel` models by name."""
    out = []
    for name, m in models.items():
        names = m.getOrDefault(m.featureCols)
        for i, t in enumerate(m.node_lists()):
            for n, f in enumerate(t["feature"]):
                out.append((name, i, n, names[f] if f >= 0 else None, t["threshold"][n] if f >= 0 else None, t["gain"][n], t["rows"][n], t["value"][n], f < 0))
    return spark.createDataFrame(out, "model string, tree int, node int, feature string, threshold double, gain double, `rows` double, value double, leaf boolean")


def importance_by_kind(nodes: DataFrame, models, features) -> DataFrame:
    """(model, feature, splits, gain, cover), each kind summing to 1 within a model; features without a split have zeros."""
    spark = nodes.sparkSession
    every = spark.createDataFrame([(m, f) for m in models for f in features], "model string, feature string")
    sums = nodes.where("not leaf").groupBy("model", "feature").agg(F.count(F.lit(1)).cast("double").alias("splits"), F.sum("gain").alias("gain"),
                                                                  F.sum("rows").alias("cover"))
    totals = sums.groupBy("model").agg(*[F.sum(k).alias(f"{k}_all") for k in ("splits", "gain", "cover")])
    joined = every.join(sums, ["model", "feature"], "left").join(F.broadcast(totals), "model", "left")
    return joined.select("model", "feature", *[F.coalesce(F.try_divide(k, f"{k}_all"), F.lit(0.0)).alias(k) for k in ("splits", "gain", "cover")])
