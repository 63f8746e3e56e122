"""M12-M15 with Spark ML's parameters: decision trees, forests and boosted trees over ``maxBins`` bins, grown together.

All trees of all settings and folds share every pass over the packed blocks (:mod:`blocks`), so a search reads its table once a level
instead of once a level, fold and setting, and caches nothing.  A pass sums rows and target by (node, feature, bin); the sums meet on
executors, which choose each node's cut there: the driver sees one row per node.  A node that several settings or folds reach by the
same tests is counted once for all of them, fold by fold, and settings that differ in ``maxDepth`` only grow once, the shallower being the
upper part of the deeper tree.  The memory of a pass is bounded by ``PASS_BYTES`` of sums, the other nodes wait.

Small nodes far above their last level (``LOCAL_ROWS`` rows, ``LOCAL_LEVELS`` levels to go) are grown to their end in one task each
(:mod:`subtrees`): their rows are shuffled once, with the held-out ones, which are scored there.

The rules are Spark's: cuts between quantile bins of all training rows (Spark takes them from a sample), at least ``minInstancesPerNode``
rows a child, ``minInfoGain`` of variance, features drawn per node, Poisson counts for bootstrap samples; boosting adds ``stepSize`` times
a tree fitted to twice the residuals, the first tree whole.  Ties: the first feature, then the lowest cut.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tabflow.models import blocks as B
from tabflow.models import boosting, subtrees

PASS_BYTES = 32 << 20          # sums of a pass, over all nodes
MEET_BYTES = 8 << 20           # sums that meet in one task
LOCAL_ROWS = 250_000
LOCAL_LEVELS = 9
REFRESH = 4                    # rounds between two writings of the predictions
NODES_AT_ONCE = 1 << 19        # nodes of growing forests that the driver may have to hold
SAME = 1e-9                    # gains as near as this are ties


@dataclass(frozen=True)
class Spec:
    boosted: bool = False
    trees: int = 1
    depth: int = 5
    min_rows: int = 1
    min_gain: float = 0.0
    columns: int | None = None     # features drawn per node, None: all
    share: float = 1.0
    bootstrap: bool = False
    step: float = 0.1
    seed: int = 42
    first: int = 0                 # the number of a forest's first tree


def _columns(strategy: str, d: int, auto: int) -> int:
    """Spark's ``featureSubsetStrategy`` as a number of features."""
    named = {"auto": auto, "all": d, "onethird": math.ceil(d / 3), "sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(d)))}
    if strategy in named:
        return named[strategy]
    return min(d, int(strategy)) if strategy.isdigit() else min(d, math.ceil(float(strategy) * d))


_TREE = {"maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed"}
_KNOWN = {"decision_tree": _TREE, "random_forest": _TREE | {"numTrees", "featureSubsetStrategy", "subsamplingRate"},
          "extra_trees": _TREE | {"numTrees", "featureSubsetStrategy", "subsamplingRate"},
          "boosted_trees": _TREE | {"maxIter", "stepSize", "featureSubsetStrategy", "subsamplingRate"}}


def spec_of(family: str, params: dict, d: int, seed: int = 42) -> tuple[Spec, int] | None:
    """A candidate's (spec, bins); None if it has parameters that only Spark's own learner knows."""
    p = params
    bins = int(p.get("maxBins", 32))
    if family not in _KNOWN or set(p) - _KNOWN[family] or not 2 <= bins <= B.BINS or d < 1:
        return None
    base = Spec(depth=int(p.get("maxDepth", 5)), min_rows=int(p.get("minInstancesPerNode", 1)), min_gain=float(p.get("minInfoGain", 0.0)),
                seed=int(p.get("seed", seed)))
    if family == "decision_tree":
        return replace(base, seed=0), bins
    share = float(p.get("subsamplingRate", 1.0))
    if family == "boosted_trees":
        k = _columns(str(p.get("featureSubsetStrategy", "all")), d, d)
        return replace(base, boosted=True, trees=int(p.get("maxIter", 20)), columns=k if k < d else None, share=share,
                       step=float(p.get("stepSize", 0.1))), bins
    trees = int(p.get("numTrees", 20))
    k = _columns(str(p.get("featureSubsetStrategy", "auto")), d, math.ceil(d / 3) if trees > 1 else d)
    return replace(base, trees=trees, columns=k if k < d else None, share=share, bootstrap=family == "random_forest"), bins


class Growing:
    """One tree: nodes by number as lists, the path of each node, and the nodes that wait for their cut."""

    def __init__(self, spec: Spec, job: int, number: int, held_out, base: float):
        self.spec, self.job, self.number, self.held_out, self.base = spec, job, number, held_out, base
        self.feature, self.cut, self.left, self.right = [-1], [0], [0], [0]
        self.value, self.gain, self.rows, self.level, self.path = [0.0], [0.0], [0.0], [0], [0]
        self.open, self.local = [0], []      # a root is counted for its value, whatever its depth

    @property
    def sampled(self) -> bool:
        return self.spec.bootstrap or self.spec.share < 1

    def arrays(self):
        return tuple(np.array(c) for c in (self.feature, self.cut, self.left, self.right))

    def drawn(self, node: int, d: int) -> np.ndarray:
        """Which features a node may be cut by."""
        mask = np.ones(d, bool)
        if self.spec.columns is not None:
            mask[:] = False
            mask[np.random.default_rng((self.spec.seed, self.number, self.path[node])).permutation(d)[:self.spec.columns]] = True
        return mask

    def rule(self) -> tuple[int, int]:
        """The fewest rows of a leaf and of a node that is cut."""
        return self.spec.min_rows, 2

    def key(self, node: int):
        """Nodes of one key hold the same rows, but for the held-out ones, and may be cut by the same features."""
        p = self.spec
        if p.boosted:
            return self.job, self.number, node
        return (p.seed, self.number, p.share, p.bootstrap, p.columns) if self.sampled or p.columns is not None else None, self.path[node]

    def take(self, node: int, found) -> None:
        n, s, gain, f, cut, nl, sl = found
        if node == 0:
            self.rows[0], self.value[0] = n, s / n if n else 0.0
        if f < 0 or self.level[node] >= self.spec.depth:
            return
        a = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node], self.gain[node] = f, cut, a, a + 1, gain
        for side, (m, t) in enumerate(((nl, sl), (n - nl, s - sl))):
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.gain, 0.0), (self.value, t / m),
                              (self.rows, m), (self.level, self.level[node] + 1),
                              (self.path, subtrees.below(self.path[node], f, cut, side))):
                column.append(x)
            if self.level[-1] < self.spec.depth and m >= max(2, 2 * self.spec.min_rows):
                self.open.append(a + side)


def _counts(tree_spec: Spec, number: int, block: dict):
    """How often each row counts: None for once each."""
    if not tree_spec.bootstrap and tree_spec.share >= 1:
        return None
    u = B.uniform(block["block"], block["n"], tree_spec.seed, number, 7)
    if not tree_spec.bootstrap:
        return (u < tree_spec.share).astype(float)
    table = np.cumsum([math.exp(-tree_spec.share) * tree_spec.share ** k / math.factorial(k) for k in range(15)])
    return np.searchsorted(table, u, side="right").astype(float)


def best_cut(hist: np.ndarray, at_feature: np.ndarray, allowed, min_rows: int, min_gain: float, scale: float):
    """Of a node's (2, bins of all features) sums of rows and target: (rows, sum, gain, feature, cut, rows left, sum left)."""
    starts, ends = at_feature[:-1], at_feature[1:]
    f0 = int(np.argmax(allowed))
    n, s = hist[:, starts[f0]:ends[f0]].sum(axis=1)
    size = ends - starts
    total = np.cumsum(hist, axis=1)
    before = np.where(starts > 0, total[:, starts - 1], 0)
    nl, sl = total - np.repeat(before, size, axis=1)
    nr, sr = n - nl, s - sl
    ok = np.repeat(allowed, size) & (nl >= min_rows) & (nr >= min_rows)
    ok[ends - 1] = False
    if n == 0 or not ok.any():
        return float(n), float(s), 0.0, -1, 0, 0.0, 0.0
    parts = sl * sl / np.where(nl > 0, nl, 1) + sr * sr / np.where(nr > 0, nr, 1)
    gain = np.where(ok, parts - s * s / n, -np.inf)
    top = gain.max()
    at = int(np.argmax(gain >= top - SAME * abs(top)))
    if not gain[at] > 1e-12 * parts[at] or scale * gain[at] / n < min_gain:
        return float(n), float(s), 0.0, -1, 0, 0.0, 0.0
    f = int(np.searchsorted(ends, at, side="right"))
    return float(n), float(s), float(gain[at] * scale), f, int(at - starts[f]), float(nl[at]), float(sl[at])


_FOUND = "model int, want int, who int, n double, s double, gain double, f int, cut int, nl double, sl double"


def _pass(table: DataFrame, work: list, packed: B.Blocks, parallel: int, run_id: str) -> list[list]:
    """The cuts found for ``work``: entries (tree, position, finished trees since, [(node, [(tree, its node) that want it])])."""
    cuts, folds = packed.cuts, np.array(sorted(packed.folds))
    d = len(cuts)
    at_feature = np.concatenate(([0], np.cumsum([len(c) + 1 for c in cuts])))
    width = int(at_feature[-1])
    told, cells = [], 0
    for t, at, since, wants in work:
        # a node that several folds want is summed fold by fold
        many = np.array([len({o.held_out for o, _ in who}) > 1 for _, who in wants])
        size = np.where(many, len(folds), 1)
        rules = [[(o.spec.min_rows, o.spec.min_gain, None if o.held_out is None else int(np.searchsorted(folds, o.held_out))) for o, _ in who] for _, who in wants]
        without = np.array([-1 if several or rule[0][2] is None else rule[0][2] for several, rule in zip(many, rules)])
        told.append((t.spec, t.number, t.base, at, [boosting._arrays(x) for x in since], t.arrays(), [w[0] for w in wants], np.cumsum(size) - size, size,
                     without, np.stack([t.drawn(w[0], d) for w in wants]), rules, 4.0 if t.spec.boosted and t.number else 1.0))
        cells += int(size.sum())
    shared = table.sparkSession.sparkContext.broadcast(told)

    def run(batches):
        jobs = shared.value
        sums = [np.zeros((2, int(j[8].sum()), width)) for j in jobs]
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                fold = np.searchsorted(folds, block["fold"])
                for (spec, number, base, at, since, nodes, wants, starts, size, without, drawn, _, _), total in zip(jobs, sums):
                    slots = np.full(len(nodes[0]), -1)
                    slots[wants] = np.arange(len(wants))
                    slot = slots.take(boosting.walk(block["bins"], *nodes))
                    use = (slot >= 0) & (without.take(slot) != fold)
                    w = _counts(spec, number, block)
                    if w is not None:
                        use &= w > 0
                    rows = np.flatnonzero(use)
                    if not len(rows):
                        continue
                    slot = slot.take(rows)
                    cell = starts.take(slot) + np.where(size.take(slot) > 1, fold.take(rows), 0)
                    g = (block["y"] - (boosting._margins(block, run_id, at, base, since) if spec.boosted else base)).take(rows)
                    if w is not None:
                        w = w.take(rows)
                        g = g * w
                    every, n = drawn.all(), total.shape[1]
                    for f in range(d):
                        a, b = at_feature[f], at_feature[f + 1]
                        if every:
                            place, gf, wf = cell * (b - a) + block["bins"][f].take(rows), g, w
                        else:
                            pick = np.flatnonzero(drawn[:, f].take(slot))
                            if not len(pick):
                                continue
                            place = cell.take(pick) * (b - a) + block["bins"][f].take(rows.take(pick))
                            gf, wf = g.take(pick), None if w is None else w.take(pick)
                        total[0, :, a:b] += np.bincount(place, wf, n * (b - a)).reshape(-1, b - a)
                        total[1, :, a:b] += np.bincount(place, gf, n * (b - a)).reshape(-1, b - a)
        for m, (job, total) in enumerate(zip(jobs, sums)):
            found = {(m, n): total[:, a:a + k] for n, (a, k) in enumerate(zip(job[7], job[8]))}
            found = {key: h for key, h in found.items() if h[0].any()}
            if found:
                yield boosting._hist_rows(found)

    def choose(batches):
        jobs, sums = shared.value, {}
        for batch in batches:
            for m, n, raw in zip(*(batch.column(c).to_pylist() for c in ("model", "want", "hist"))):
                h = np.frombuffer(raw).reshape(2, -1, width)
                sums[m, n] = sums[m, n] + h if (m, n) in sums else h
        rows = []
        for (m, n), h in sums.items():
            job, done = jobs[m], {}
            for k, rule in enumerate(job[11][n]):
                if rule not in done:
                    rest = h.sum(axis=1) if h.shape[1] == 1 or rule[2] is None else h[:, np.arange(h.shape[1]) != rule[2]].sum(axis=1)
                    done[rule] = best_cut(rest, at_feature, job[10][n], rule[0], rule[1], job[12])
                rows.append((m, n, k, *done[rule]))
        if rows:
            cols, kinds = list(zip(*rows)), [pa.int32()] * 3 + [pa.float64()] * 3 + [pa.int32()] * 2 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [c.split()[0] for c in _FOUND.split(", ")])

    meet = max(1, min(parallel, parallel * cells * 2 * width * 8 // MEET_BYTES))
    out = [[[None] * len(w[1]) for w in wants] for _, _, _, wants in work]
    for r in table.mapInArrow(run, boosting._HIST).repartition(meet, "model", "want").mapInArrow(choose, _FOUND).collect():
        out[r["model"]][r["want"]][r["who"]] = tuple(r)[3:]
    shared.unpersist()
    nothing = (0.0, 0.0, 0.0, -1, 0, 0.0, 0.0)
    return [[[x or nothing for x in found] for found in wants] for wants in out]


@dataclass
class Grown:
    """The trees of one job: a forest's, or a booster's in order with their values as they are added."""
    spec: Spec
    held_out: object
    base: float
    trees: list


def _stay_local(t: Growing, local_rows: int) -> None:
    """Nodes that a task can grow to their end leave the passes."""
    if t.sampled or t.spec.boosted or t.spec.columns is not None:
        return
    ready = [n for n in t.open if n and t.rows[n] <= local_rows and t.spec.depth - t.level[n] >= LOCAL_LEVELS]
    if ready:
        gone = set(ready)
        t.local += ready
        t.open = [n for n in t.open if n not in gone]


def grow(packed: B.Blocks, jobs, pass_bytes: int = PASS_BYTES, local_rows: int = LOCAL_ROWS, refresh: int = REFRESH,
         keep_trees: bool = True):
    """(models, table, run id, trees written) of jobs (spec, held-out fold or None); the table carries the boosters' predictions.
    Without ``keep_trees`` the driver forgets a booster's trees once their predictions are written (None stands for each)."""
    # trees that share their counts have one base
    done = [Grown(p, f, packed.training(f if p.boosted else None)[1], []) for p, f in jobs]
    boosters = [j for j, g in enumerate(done) if g.spec.boosted]
    place = {j: i for i, j in enumerate(boosters)}
    current = {}
    for j, g in enumerate(done):
        if g.spec.boosted:
            current[j] = [Growing(g.spec, j, 0, g.held_out, g.base)]
        else:
            current[j] = g.trees = [Growing(g.spec, j, k, g.held_out, g.base) for k in range(g.spec.first, g.spec.first + g.spec.trees)]
    table, written, run_id = packed.table, [0] * len(boosters), os.urandom(8).hex()
    parallel = table.rdd.getNumPartitions()
    width = sum(len(c) + 1 for c in packed.cuts)
    room = max(1, pass_bytes // (2 * width * 8))
    while True:
        work, left, seen = [], room, {}
        several = len({done[j].held_out for j in current}) > 1
        for j, trees in current.items():
            for t in trees:
                wants, later = [], []
                for node in t.open:
                    key = t.key(node)
                    if key in seen:
                        seen[key].append((t, node))
                    elif left > 0:
                        seen[key] = [(t, node)]
                        wants.append((node, seen[key]))
                        left -= len(packed.folds) if several and not t.spec.boosted else 1
                    else:
                        later.append(node)
                t.open = later
                if wants:
                    at = place.get(j, 0)
                    work.append((t, at, done[j].trees[written[at]:] if t.spec.boosted else [], wants))
        if not work:
            break
        for (_, _, _, wants), found in zip(work, _pass(table, work, packed, parallel, run_id)):
            for (_, who), cuts in zip(wants, found):
                for (t, node), cut in zip(who, cuts):
                    t.take(node, cut)
                    _stay_local(t, local_rows)
        for j in boosters:
            t = current[j][0] if j in current else None
            if t is not None and not t.open:
                step = 2 * t.spec.step if t.number else 1.0
                t.value = [v * step for v in t.value]
                done[j].trees.append(t)
                current[j] = [Growing(t.spec, j, t.number + 1, t.held_out, t.base)] if t.number + 1 < t.spec.trees else []
        current = {j: trees for j, trees in current.items() if trees}
        # a table is written anew when all boosters that still grow have added enough trees
        since = [len(done[j].trees) - w for j, w in zip(boosters, written)]
        if any(j in current for j in boosters) and max(since) >= refresh:
            new = boosting._refreshed(table, [done[j].base for j in boosters], [done[j].trees[w:] for j, w in zip(boosters, written)], run_id)
            if table is not packed.table:
                B.discard(table)
            table, run_id = new, os.urandom(8).hex()
            written, parallel = [len(done[j].trees) for j in boosters], table.rdd.getNumPartitions()
            if not keep_trees:
                for j in boosters:
                    done[j].trees = [None] * len(done[j].trees)
    return done, table, run_id, written


def _cut_at(t: Growing, depth: int) -> tuple:
    """The tree's arrays with the nodes at a depth as leaves."""
    inner = [f if lv < depth else -1 for f, lv in zip(t.feature, t.level)]
    return tuple(np.array(c) for c in (inner, t.cut, t.left, t.right, t.value))


def model_of(packed: B.Blocks, grown: Grown, depth: int | None = None, prediction_col: str = "prediction") -> boosting.TreesModel:
    """Spark's importances: a forest's trees count alike, a booster's by their gains."""
    named = []
    for t in grown.trees:
        depth_t = t.spec.depth if depth is None else depth
        inner = [f if lv < depth_t else -1 for f, lv in zip(t.feature, t.level)]
        gain = np.where(np.array(inner) >= 0, t.gain, 0.0)
        if not grown.spec.boosted and gain.sum() > 0:
            gain = gain / gain.sum()
        named.append({"feature": [int(f) for f in inner], "left": t.left, "right": t.right, "value": [float(v) for v in t.value], "gain": [float(g) for g in gain],
                      "rows": [float(r) for r in t.rows], "threshold": [float(packed.cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(inner, t.cut)]})
    return boosting.TreesModel(packed.features, named, grown.base, prediction_col, "sum" if grown.spec.boosted else "mean")


def _score(packed: B.Blocks, entries) -> dict:
    """{entry: sums of rows, squared and absolute errors} on the held-out folds; entries (grown forest, depth).  Rows that end in a
    node grown elsewhere are left out."""
    told = []
    for grown, depth in entries:
        trees = [(_cut_at(t, depth), np.isin(np.arange(len(t.feature)), [n for n in t.local if t.level[n] < depth])) for t in grown.trees]
        told.append((grown.held_out, grown.base, trees))
    shared = packed.table.sparkSession.sparkContext.broadcast(told)

    def run(batches):
        sums = np.zeros((len(shared.value), 3))
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                held = {}
                for m, (held_out, base, trees) in enumerate(shared.value):
                    if held_out not in held:
                        rows = np.flatnonzero(block["fold"] == held_out)
                        held[held_out] = np.ascontiguousarray(block["bins"][:, rows]), block["y"][rows]
                    bins, y = held[held_out]
                    total, here = np.zeros(len(y)), np.ones(len(y), bool)
                    for (*nodes, value), elsewhere in trees:
                        leaf = boosting.walk(bins, *nodes)
                        total += value[leaf]
                        here &= ~elsewhere[leaf]
                    e = (total / len(trees) + base - y)[here]
                    sums[m] += len(e), (e * e).sum(), np.abs(e).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32())] + [pa.array(sums[:, k]) for k in range(3)], ["model", "n", "sse", "sae"])

    got = packed.table.mapInArrow(run, "model int, n double, sse double, sae double").groupBy("model").sum("n", "sse", "sae").collect()
    shared.unpersist()
    return {m: np.array([n, sse, sae]) for m, n, sse, sae in got}


def cross_validate(df: DataFrame, candidates, features, target: str, fold_col: str, on_null: str = "error", keep: dict | None = None, packs=None) -> list[tuple]:
    """(name, fold, n, rmse, mae, r2) of candidates (name, spec, bins); ``keep`` receives every fold model as (name, fold) -> model;
    ``packs`` holds blocks for several calls (:class:`blocks.Packs`)."""
    out = []
    with B.Packs.of(packs, df, features, target, fold_col, on_null) as packs:
        for bins in sorted({b for _, _, b in candidates}):
            out += _cross_validated(packs.get(fold_col, bins), [(name, spec) for name, spec, b in candidates if b == bins], keep)
    return out


def _cross_validated(packed: B.Blocks, candidates, keep) -> list[tuple]:
    """All at once while that bounds the predictions in a block and the nodes on the driver, else in parts of that size."""
    folds = sorted(packed.folds)
    boosters, forests = [c for c in candidates if c[1].boosted], [c for c in candidates if not c[1].boosted]
    whole = _deepest(forests)
    out = {}
    large = [s for s in dict.fromkeys(whole.values()) if s.trees > 1]      # single trees are few and may leave the passes
    if keep is None and sum(_nodes(packed, s) for s in large) * len(folds) > NODES_AT_ONCE:
        for shape in large:
            out |= _forest_in_parts(packed, shape, [c for c in forests if whole[c[1]] == shape])
        forests = [c for c in forests if whole[c[1]] not in large]
    # the first boosters share their passes with the forests
    size = max(1, boosting.AT_ONCE // max(1, len(folds)))
    for a in range(0, max(len(boosters), bool(forests)), size):
        out |= {(r[0], r[1]): r for r in _together_validated(packed, forests + boosters[a:a + size], keep)}
        forests = []
    return [out[name, f] for name, _ in candidates for f in folds]


def _deepest(forests) -> dict:
    """{spec: the spec of the deepest tree of the same shape}: settings that differ in depth only are parts of one tree."""
    deepest = {}
    for _, spec in forests:
        shape = replace(spec, depth=0)
        deepest[shape] = max(deepest.get(shape, 0), spec.depth)
    return {spec: replace(spec, depth=deepest[replace(spec, depth=0)]) for _, spec in forests}


def _nodes(packed: B.Blocks, spec: Spec) -> int:
    """Nodes that a forest's trees can have at most."""
    rows = sum(s[0] for s in packed.folds.values())
    return spec.trees * int(min(2 ** (spec.depth + 1), 2 * max(1, rows / max(1, spec.min_rows))))


def _forest_in_parts(packed: B.Blocks, spec: Spec, candidates) -> dict:
    """{(name, fold): its row} of candidates that are upper parts of one forest too large for the driver: some trees grow on all folds, their
    predictions of the held-out rows are added to the blocks, and they are forgotten."""
    folds = sorted(packed.folds)
    size = max(1, NODES_AT_ONCE // (len(folds) * _nodes(packed, replace(spec, trees=1))))
    depths = sorted({s.depth for _, s in candidates})
    table = packed.table
    try:
        for a in range(0, spec.trees, size):
            grown = grow(packed, [(replace(spec, first=a, trees=min(size, spec.trees - a)), f) for f in folds], local_rows=0)[0]
            new = _added(table, grown, depths)
            if table is not packed.table:
                B.discard(table)
            table = new
        sums = _score_added(table, folds, len(depths), grown[0].base, spec.trees)
    finally:
        if table is not packed.table:
            B.discard(table)
    return {(name, f): _metrics_row(packed, name, f, sums[depths.index(s.depth), f]) for name, s in candidates for f in folds}


def _added(table: DataFrame, grown, depths) -> DataFrame:
    """The blocks with the sums of these trees' values at every depth added, each row by the forest that holds out its fold."""
    told = table.sparkSession.sparkContext.broadcast([(g.held_out, [[_cut_at(t, depth) for t in g.trees] for depth in depths]) for g in grown])
    plain = [c for c in table.schema.names if c != "margins"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                m = block["margins"].copy() if "margins" in block else np.zeros((len(depths), block["n"]))
                for held_out, by_depth in told.value:
                    rows = np.flatnonzero(block["fold"] == held_out)
                    bins = np.ascontiguousarray(block["bins"][:, rows])
                    for k, trees in enumerate(by_depth):
                        for *nodes, value in trees:
                            m[k, rows] += value[boosting.walk(bins, *nodes)]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, 1) for c in plain] + [pa.array([m.tobytes()], pa.binary())], plain + ["margins"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema if f.name != "margins") + ", margins binary"
    try:
        return B._written(table.mapInArrow(run, schema), "margins")
    finally:
        told.unpersist()


def _score_added(table: DataFrame, folds, n_depths: int, base: float, trees: int) -> dict:
    """{(depth's place, fold): sums of rows, squared and absolute errors} of the added predictions."""
    def run(batches):
        sums = np.zeros((n_depths, len(folds), 3))
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                e = block["margins"] / trees + base - block["y"]
                for j, f in enumerate(folds):
                    of = e[:, block["fold"] == f]
                    sums[:, j] += np.stack([np.full(n_depths, of.shape[1]), (of * of).sum(axis=1), np.abs(of).sum(axis=1)], axis=1)
        flat = sums.reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32())] + [pa.array(flat[:, k]) for k in range(3)], ["model", "n", "sse", "sae"])

    got = table.mapInArrow(run, "model int, n double, sse double, sae double").groupBy("model").sum("n", "sse", "sae").collect()
    return {(m // len(folds), folds[m % len(folds)]): np.array([n, sse, sae]) for m, n, sse, sae in got}


def _metrics_row(packed: B.Blocks, name: str, fold, sums) -> tuple:
    n, sse, sae = map(float, sums)
    sst = packed.folds[fold][2]
    return name, fold, int(n), math.sqrt(sse / n), sae / n, 1 - sse / sst if sst > 0 else float(sse == 0)


def _together_validated(packed: B.Blocks, candidates, keep) -> list[tuple]:
    folds = sorted(packed.folds)
    of_shape = _deepest([c for c in candidates if not c[1].boosted])
    whole = lambda s: s if s.boosted else of_shape[s]
    shapes = list(dict.fromkeys(whole(s) for _, s in candidates))
    jobs = [(s, f) for s in shapes for f in folds]
    done, table, run_id, written = grow(packed, jobs, local_rows=LOCAL_ROWS if keep is None else 0, keep_trees=keep is not None)
    try:
        of = {job: g for job, g in zip(jobs, done)}
        rows = [(name, f, of[whole(s), f], s) for name, s in candidates for f in folds]
        fitted = [boosting.Fitted(boosting.BoostParams(), g.base, g.trees, g.held_out) for g in done if g.spec.boosted]
        if fitted:
            boosting._score_held_out(packed, table, fitted, written, run_id)
        boosted = {id(g): m.metrics for g, m in zip([g for g in done if g.spec.boosted], fitted)}
        forests = [(g, s.depth) for _, _, g, s in rows if not s.boosted]
        sums = _score(packed, forests) if forests else {}
        for m, found in subtrees.finish(packed, forests).items():
            sums[m] = sums[m] + found
    finally:
        if table is not packed.table:
            B.discard(table)
    out, m = [], 0
    for name, f, g, s in rows:
        if s.boosted:
            out.append((name, f, *boosted[id(g)]))
        else:
            out.append(_metrics_row(packed, name, f, sums[m]))
            m += 1
        if keep is not None:
            keep[name, f] = PipelineModel([model_of(packed, g, None if s.boosted else s.depth, "__p")])
    return out


def fit_together(df: DataFrame, candidates, features, target: str, on_null: str = "error") -> dict:
    """{name: model} of candidates (name, spec, bins), grown together on all rows."""
    out = {}
    for bins in sorted({b for _, _, b in candidates}):
        packed = B.pack(df, features, target, bins=bins, on_null=on_null)
        try:
            chosen = [(name, spec) for name, spec, b in candidates if b == bins]
            done, table, _, _ = grow(packed, [(s, None) for _, s in chosen], local_rows=0)
            if table is not packed.table:
                B.discard(table)
            out.update({name: PipelineModel([model_of(packed, g, None, f"pred_{name}")]) for (name, _), g in zip(chosen, done)})
        finally:
            B.discard(packed.table)
    return out
