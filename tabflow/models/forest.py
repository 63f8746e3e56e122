"""Decision trees, random forests and extra trees, level by level, all trees at once.

Trees of all settings and folds of a search share every pass over the packed blocks (:mod:`blocks`, with raw values).

Best cuts are exact, between any two neighbouring values of a node.  A pass gives, per node and feature, rows, sum and square sum of
the target and the smallest and largest value of each byte bin; between bins the gain of a cut is known.  A cut inside a
bin explains at most what the three groups left of the bin, bin and right of it explain, plus the bin's own scatter;
bins that could still hold the best cut are cut again into 256 equal ranges by further passes, until none is left (a range holds its
smallest and largest value apart, so each pass makes progress; a bin of one value is never cut again).  No values are ever gathered.

Extra trees draw a threshold by seed inside each node's own range of a feature: one pass for the ranges, one for the sums left of
the thresholds.

A node is split if it has ``min_samples_split`` rows, is above ``max_depth`` and not pure, into children of ``min_samples_leaf`` rows
at least, by the test of largest reduction of the square error among ``max_features`` features drawn by seed per node (constant ones do not
count).  Bootstrap samples are seeded Poisson counts per row.  Ties: the first feature, then the lowest threshold.
The memory of a pass is bounded: it works on as many nodes as ``PASS_ROWS`` sums allow, the others wait; a task merges its sums
as they come and they meet on executors.

In a cross-validation, trees over all rows and features leave the passes early: nodes of at most ``LOCAL_ROWS`` rows with ``LOCAL_LEVELS``
levels to go are shuffled once and grown to their end in one task each (:mod:`subtrees`), for all settings that reach them by the same tests.
Settings that differ in ``max_depth`` or ``min_samples_split`` are parts of one tree then, and a cut found for one ``min_samples_leaf`` is taken
over by a larger one that it satisfies.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from tabflow.models import blocks as B
from tabflow.models import subtrees
from tabflow.models.boosting import TreesModel, walk

SPLITS = 256
PASS_ROWS = 2_000_000          # sums of a pass, over all nodes
PENDING_ROWS = 1_000_000       # sums of a task that wait to be merged
LOCAL_ROWS = 250_000
LOCAL_LEVELS = 9


@dataclass(frozen=True)
class ForestParams:
    n_estimators: int = 1
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: object = None    # None: all, "sqrt", "log2", a number of features or a share
    bootstrap: bool = False
    random_cuts: bool = False
    seed: int = 42

    def n_features(self, d: int) -> int:
        m = self.max_features
        k = {None: d, "sqrt": math.isqrt(d), "log2": int(math.log2(d)) if d else 0}.get(m) if m is None or isinstance(m, str) else m
        if k is None:
            raise ValueError(f"unknown max_features {m!r}")
        return min(d, max(1, int(k * d) if isinstance(k, float) else k))

    def plain(self, d: int) -> bool:
        """All rows, all features, best cuts: nothing is drawn."""
        return not self.bootstrap and not self.random_cuts and self.n_features(d) == d


@dataclass
class Growing:
    """One tree: nodes by number as lists, and the nodes that wait for their split."""
    params: ForestParams
    number: int
    held_out: object
    base: float
    feature: list = field(default_factory=lambda: [-1])
    threshold: list = field(default_factory=lambda: [0.0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])
    rows: list = field(default_factory=lambda: [0.0])
    level: list = field(default_factory=lambda: [0])
    path: list = field(default_factory=lambda: [0])
    open: list = field(default_factory=lambda: [0])
    local: list = field(default_factory=list)
    alone: set = field(default_factory=set)

    def arrays(self):
        return tuple(np.array(c) for c in (self.feature, self.threshold, self.left, self.right))

    def features_of(self, node: int, d: int) -> np.ndarray:
        """The order in which a node tries its features."""
        return np.random.default_rng((self.params.seed, self.number, node)).permutation(d)

    def split(self, node, f, threshold, gain, left, right):
        """``left`` and ``right``: (rows, sum) of the children."""
        a = len(self.feature)
        self.feature[node], self.threshold[node], self.left[node], self.right[node], self.gain[node] = int(f), float(threshold), a, a + 1, float(gain)
        for side, (n, s) in enumerate((left, right)):
            for column, x in ((self.path, subtrees.below(self.path[node], int(f), float(threshold), side)), (self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.right, 0), (self.gain, 0.0),
                              (self.value, float(self.base + s / n)), (self.rows, float(n)), (self.level, self.level[node] + 1)):
                column.append(x)
        self.open += [c for c in (a, a + 1) if self.may_split(c)]

    def may_split(self, node) -> bool:
        p = self.params
        return (p.max_depth is None or self.level[node] < p.max_depth) and self.rows[node] >= max(2, p.min_samples_split, 2 * p.min_samples_leaf)

    def rule(self) -> tuple[int, int]:
        """The fewest rows of a leaf and of a node that is cut."""
        return self.params.min_samples_leaf, max(2, self.params.min_samples_split)

    def cut_at(self, depth: int | None, min_split: int = 0) -> dict:
        """The tree's nodes, with those at a depth, or of fewer rows, as leaves."""
        inner = [f if (depth is None or lv < depth) and n >= min_split else -1 for f, lv, n in zip(self.feature, self.level, self.rows)]
        return {"feature": inner, "threshold": self.threshold, "left": self.left, "right": self.right, "value": self.value, "gain": self.gain, "rows": self.rows}


def _weights(block: dict, tree_params: ForestParams, number: int, held_out) -> np.ndarray:
    """How often each row counts: 0 in the held-out fold, Poisson counts of mean one in a bootstrap sample."""
    w = np.ones(block["n"])
    if tree_params.bootstrap:
        u = B.uniform(block["block"], block["n"], tree_params.seed, number, 5)
        w = np.searchsorted(_POISSON, u, side="right").astype(float)
    if held_out is not None:
        w[block["fold"] == held_out] = 0
    return w


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(15)])
_SUMS = "model int, key long, n double, s double, q double, lo double, hi double"


def _grouped(key, x, w, g):
    """(keys, n, s, q, lo, hi) per distinct key, without sorting where the keys lie close."""
    first = int(key.min())
    place = key - first
    size = int(place.max()) + 1
    if size <= 4 * len(key) + 4 * SPLITS:
        n, lo, hi = np.bincount(place, w, size), np.full(size, np.inf), np.full(size, -np.inf)
        np.minimum.at(lo, place, x)
        np.maximum.at(hi, place, x)
        at = np.flatnonzero(n)
        return (at + first, *[c[at] for c in (n, np.bincount(place, w * g, size), np.bincount(place, w * g * g, size), lo, hi)])
    order = np.lexsort((x, key))
    key, x, w, g = key[order], x[order], w[order], g[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    last = np.concatenate((at[1:], [len(key)])) - 1
    add = lambda v: np.add.reduceat(v, at)
    return key[at], add(w), add(w * g), add(w * g * g), x[at], x[last]


def _merged(parts):
    """Partial sums of several tasks by key."""
    if not len(parts[0]):
        return tuple(np.zeros(0, np.int64) if i == 0 else np.zeros(0) for i in range(6))
    key = parts[0]
    order = np.argsort(key, kind="stable")
    cols = [c[order] for c in parts]
    at = np.flatnonzero(np.concatenate(([True], cols[0][1:] != cols[0][:-1])))
    return (cols[0][at], *[np.add.reduceat(c, at) for c in cols[1:4]], np.minimum.reduceat(cols[4], at), np.maximum.reduceat(cols[5], at))


def _pass(table: DataFrame, work: list, rows_of) -> dict:
    """Per entry of ``work`` (tree, plan): the merged sums of ``rows_of(block, leaf, weights, plan)`` -> (key, x, w, row indices)."""
    shared = table.sparkSession.sparkContext.broadcast([(t.params, t.number, t.held_out, t.base, t.arrays(), plan) for t, plan in work])

    def run(batches):
        parts, pending = {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                for m, (params, number, held_out, base, nodes, plan) in enumerate(shared.value):
                    w = _weights(block, params, number, held_out)
                    leaf = walk(block["x"], *nodes)
                    for key, x, at, *named in rows_of(block, leaf, np.flatnonzero(w > 0), plan):
                        if len(key):
                            found = _grouped(key, x, w[at], block["y"][at] - base)
                            parts.setdefault(m, []).append((named[0](found[0]), *found[1:]) if named else found)
                            pending[m] = pending.get(m, 0) + len(parts[m][-1][0])
                if sum(pending.values()) > PENDING_ROWS:
                    parts, pending = {m: [_merged([np.concatenate(c) for c in zip(*found)])] for m, found in parts.items()}, {}
        for m, found in parts.items():
            sums = _merged([np.concatenate(c) for c in zip(*found)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sums[0]), m), pa.int32()), *[pa.array(c) for c in sums]],
                                             ["model", "key", "n", "s", "q", "lo", "hi"])

    sums = table.mapInArrow(run, _SUMS).groupBy("model", "key")
    got = sums.agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")], F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
    shared.unpersist()
    model = got.column("model").to_numpy()
    cols = [got.column(c).to_numpy() for c in ("key", "n", "s", "q", "lo", "hi")]
    return {m: _merged([c[model == m] for c in cols]) for m in range(len(work))}


def _first_rows(block, leaf, rows, plan):
    """Byte bins of the wanted features of the wanted nodes: key = (slot * d + feature) * SPLITS + bin, made of slot * SPLITS + bin."""
    slots, wanted = plan
    slot = slots[leaf[rows]]
    rows, slot = rows[slot >= 0], slot[slot >= 0]
    d = wanted.shape[1]
    for f in range(d):
        use = wanted[slot, f]
        at = rows[use]
        yield slot[use] * SPLITS + block["bins"][f, at], block["x"][f, at], at, lambda key, f=f: (key // SPLITS * d + f) * SPLITS + key % SPLITS


def _range_rows(block, leaf, rows, plan):
    """Ranges inside byte bins, one at a time for each (node, feature, bin): key = range * SPLITS + part."""
    slots, d, index, lo, hi = plan
    slot = slots[leaf[rows]]
    rows, slot = rows[slot >= 0], slot[slot >= 0]
    for f in range(d):
        base = (slot * d + f) * SPLITS
        place = base + block["bins"][f, rows]
        k = np.searchsorted(index[0], place)
        k[k == len(index[0])] = 0
        hit = index[0][k] == place
        at, want = rows[hit], index[1][k[hit]]
        x = block["x"][f, at]
        inside = (x >= lo[want]) & (x <= hi[want])
        at, want, x = at[inside], want[inside], x[inside]
        part = ((x / 2 - lo[want] / 2) / (hi[want] / 2 - lo[want] / 2) * SPLITS).astype(np.int64)
        yield want * SPLITS + np.minimum(part, SPLITS - 1), x, at


def _edges(group, sums, n0, s0, total_n, total_s, leaf):
    """Of sums ordered by (group, value), with rows and sum left of each group: gains of the cuts behind each, thresholds, bounds."""
    n, s, q, lo, hi = sums
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.concatenate((start, [len(group)])))
    before = lambda c: np.cumsum(c) - c
    shift = lambda c: before(c) - np.repeat(before(c)[start], size)
    nb, sb = shift(n) + n0, shift(s) + s0                    # left of each entry
    na, sa = nb + n, sb + s                                  # with it
    part = lambda s, n: np.where(n > 0, s * s / np.where(n > 0, n, 1), 0)
    whole = part(total_s, total_n)
    gain = part(sa, na) + part(total_s - sa, total_n - na) - whole
    following = np.concatenate((lo[1:], [np.nan]))
    threshold = hi + (following - hi) / 2
    threshold = np.where(threshold < following, threshold, hi)
    inner = np.concatenate((group[1:] == group[:-1], [False]))
    gain = np.where(inner & (na >= leaf) & (total_n - na >= leaf), gain, -np.inf)
    scatter = np.maximum(q - part(s, n), 0)
    bound = part(sb, nb) + part(s, n) + part(total_s - sa, total_n - na) - whole + scatter
    loose = (hi > lo) & (na - 1 >= leaf) & (total_n - nb - 1 >= leaf)
    return gain, threshold, np.where(loose, bound, -np.inf), nb, sb, na, sa


def _best_cuts(table: DataFrame, work: list, d: int) -> list[dict]:
    """Per (tree, nodes): node -> (gain, feature, threshold, left (n, s), right (n, s), all (n, s)), exact."""
    plans = []
    for tree, nodes in work:
        slots = np.full(len(tree.feature), -1)
        slots[nodes] = np.arange(len(nodes))
        k, wanted = tree.params.n_features(d), np.ones((len(nodes), d), bool)
        order = None
        if k < d:
            # all features are counted, so that constant ones can be passed over
            order = np.stack([tree.features_of(n, d) for n in nodes])
        plans.append((slots, wanted, order, k))
    first = _pass(table, [(t, (p[0], p[1])) for (t, _), p in zip(work, plans)], _first_rows)
    best, open_, totals = [], [], []
    for m, ((tree, nodes), (slots, wanted, order, k)) in enumerate(zip(work, plans)):
        key, *sums = first[m]
        group, place = key // SPLITS, key
        slot, f = group // d, group % d
        n_all = np.zeros(len(nodes))
        s_all = np.zeros(len(nodes))
        q_all = np.zeros(len(nodes))
        for total, c in ((n_all, sums[0]), (s_all, sums[1]), (q_all, sums[2])):
            np.add.at(total, slot[f == 0], c[f == 0])
        if order is not None:
            low, high = np.full((len(nodes), d), np.inf), np.full((len(nodes), d), -np.inf)
            np.minimum.at(low, (slot, f), sums[3])
            np.maximum.at(high, (slot, f), sums[4])
            varies = np.take_along_axis(high > low, order, 1)
            chosen = varies & (np.cumsum(varies, axis=1) <= k)
            mask = np.zeros((len(nodes), d), bool)
            np.put_along_axis(mask, order, chosen, 1)
            keep = mask[slot, f]
            place, group, slot, f, sums = place[keep], group[keep], slot[keep], f[keep], [c[keep] for c in sums]
        zero = np.zeros(len(place))
        made = _edges(group, sums, zero, zero, n_all[slot], s_all[slot], tree.params.min_samples_leaf) if len(place) else None
        chosen_cut: dict = {}
        rest = []
        if made:
            _take_best(chosen_cut, slot, f, made)
            rest = _unresolved(chosen_cut, slot, f, place, sums, made)
        best.append(chosen_cut)
        open_.append(rest)
        totals.append((n_all, s_all, q_all))
    while True:
        batch = []
        for m, rest in enumerate(open_):
            floor = best[m]
            rest = [r for r in rest if r["bound"] > floor.get(r["slot"], (0.0,))[0] * (1 + 1e-12) + 1e-12]
            open_[m] = rest
            now, seen = [], set()
            for r in rest:
                if r["place"] not in seen:
                    seen.add(r["place"])
                    now.append(r)
            if now:
                now.sort(key=lambda r: r["place"])
                batch.append((m, now))
        if not batch:
            break
        told = [(work[m][0], (plans[m][0], d, (np.array([r["place"] for r in now]), np.arange(len(now))), np.array([r["lo"] for r in now]),
                              np.array([r["hi"] for r in now]))) for m, now in batch]
        got = _pass(table, told, _range_rows)
        for i, (m, now) in enumerate(batch):
            key, *sums = got[i]
            want = key // SPLITS
            column = lambda name: np.array([r[name] for r in now])[want]  # noqa: E731,B023
            slot, f, place = column("slot"), column("f"), column("place")
            n_all, s_all, _ = totals[m]
            made = _edges(want, sums, column("n0"), column("s0"), n_all[slot], s_all[slot], work[m][0].params.min_samples_leaf)
            _take_best(best[m], slot, f, made)
            done = {id(r) for r in now}
            open_[m] = [r for r in open_[m] if id(r) not in done] + _unresolved(best[m], slot, f, place, sums, made)
    out = []
    for m, (tree, nodes) in enumerate(work):
        n_all, s_all, q_all = totals[m]
        found = {}
        for i, node in enumerate(nodes):
            whole = (n_all[i], s_all[i])
            if i in best[m] and best[m][i][0] > 1e-12 * max(1.0, q_all[i]):
                gain, f, threshold, nl, sl = best[m][i]
                found[node] = (gain, f, threshold, (nl, sl), (whole[0] - nl, whole[1] - sl), whole)
            else:
                found[node] = (0.0, -1, 0.0, None, None, whole)
        out.append(found)
    return out


def _take_best(best: dict, slot, f, made) -> None:
    gain, threshold, _, _, _, na, sa = made
    usable = np.flatnonzero(np.isfinite(gain))
    # by node, then the largest gain, the first feature, the lowest threshold
    order = usable[np.lexsort((threshold[usable], f[usable], -gain[usable], slot[usable]))]
    first = np.concatenate(([True], slot[order][1:] != slot[order][:-1])) if len(order) else []
    for i in order[first]:
        cut = (float(gain[i]), int(f[i]), float(threshold[i]), float(na[i]), float(sa[i]))
        old = best.get(int(slot[i]))
        if old is None or (-cut[0], cut[1], cut[2]) < (-old[0], old[1], old[2]):
            best[int(slot[i])] = cut


def _unresolved(best: dict, slot, f, place, sums, made) -> list[dict]:
    """The entries that could still hold a better cut than their node's best."""
    bound, nb, sb = made[2], made[3], made[4]
    floor = np.zeros(int(slot.max()) + 1 if len(slot) else 1)
    for i, cut in best.items():
        if i < len(floor):
            floor[i] = max(cut[0], 0.0)
    open_ = np.flatnonzero(np.isfinite(bound) & (bound > floor[slot] * (1 + 1e-12) + 1e-12))
    return [{"slot": int(slot[i]), "f": int(f[i]), "place": int(place[i]), "lo": float(sums[3][i]), "hi": float(sums[4][i]), "n0": float(nb[i]),
             "s0": float(sb[i]), "bound": float(bound[i])} for i in open_]


def _all_values(block, leaf, rows, plan):
    """Every feature of the wanted nodes as one group: key = slot * d + feature."""
    slots, d = plan
    slot = slots[leaf[rows]]
    rows, slot = rows[slot >= 0], slot[slot >= 0]
    for f in range(d):
        yield slot * d + f, block["x"][f, rows], rows


def _left_values(block, leaf, rows, plan):
    """Rows left of the drawn thresholds: key = slot * d + feature."""
    slots, thresholds = plan
    slot = slots[leaf[rows]]
    rows, slot = rows[slot >= 0], slot[slot >= 0]
    d = thresholds.shape[1]
    for f in range(d):
        x = block["x"][f, rows]
        use = x <= thresholds[slot, f]          # a feature without a threshold has NaN
        yield slot[use] * d + f, x[use], rows[use]


def _random_cuts(table: DataFrame, work: list, d: int) -> list[dict]:
    """As :func:`_best_cuts`, with one threshold drawn per node and feature inside the node's own range."""
    slots_of = []
    for tree, nodes in work:
        slots = np.full(len(tree.feature), -1)
        slots[nodes] = np.arange(len(nodes))
        slots_of.append(slots)
    ranges = _pass(table, [(t, (s, d)) for (t, _), s in zip(work, slots_of)], _all_values)
    drawn, totals = [], []
    for m, (tree, nodes) in enumerate(work):
        key, n, s, q, lo, hi = ranges[m]
        slot, f = key // d, key % d
        thresholds = np.full((len(nodes), d), np.nan)
        low, high = np.zeros((len(nodes), d)), np.zeros((len(nodes), d))
        low[slot, f], high[slot, f] = lo, hi
        for i, node in enumerate(nodes):
            order = tree.features_of(node, d)
            order = order[high[i, order] > low[i, order]][:tree.params.n_features(d)]
            u = np.random.default_rng((tree.params.seed, tree.number, node, 1)).random(d)
            # x <= threshold leaves the largest value to the right
            cut = low[i] + u * (high[i] - low[i])
            thresholds[i, order] = np.where(cut[order] < high[i, order], cut[order], low[i, order])
        all_n, all_s, all_q = (np.zeros(len(nodes)) for _ in range(3))
        one = f == 0
        all_n[slot[one]], all_s[slot[one]], all_q[slot[one]] = n[one], s[one], q[one]
        drawn.append(thresholds)
        totals.append((all_n, all_s, all_q))
    sums = _pass(table, [(t, (s, th)) for (t, _), s, th in zip(work, slots_of, drawn)], _left_values)
    out = []
    for m, (tree, nodes) in enumerate(work):
        key, n, s, *_ = sums[m]
        slot, f = key // d, key % d
        all_n, all_s, all_q = totals[m]
        right_n, right_s = all_n[slot] - n, all_s[slot] - s
        leaf = tree.params.min_samples_leaf
        ok = (n >= leaf) & (right_n >= leaf)
        gain = np.where(ok, s * s / n + right_s ** 2 / np.where(right_n > 0, right_n, 1) - all_s[slot] ** 2 / all_n[slot], -np.inf)
        found = {node: (0.0, -1, 0.0, None, None, (all_n[i], all_s[i])) for i, node in enumerate(nodes)}
        for i in np.lexsort((-f, gain)):
            node = nodes[slot[i]]
            if gain[i] > 1e-12 * max(1.0, all_q[slot[i]]):
                found[node] = (gain[i], f[i], drawn[m][slot[i], f[i]], (n[i], s[i]), (right_n[i], right_s[i]), (all_n[slot[i]], all_s[slot[i]]))
        out.append(found)
    return out


def grow(packed: B.Blocks, jobs, pass_rows: int = PASS_ROWS, local_rows: int = 0) -> list[list[Growing]]:
    """The trees of each job (params, held-out fold or None); all jobs of a kind grow together.  Nodes of at most ``local_rows`` rows
    far above their last level are left to tasks (``Growing.local``)."""
    d = len(packed.features)
    if d < 1:
        raise ValueError("a tree needs at least one feature")
    forests = [[Growing(p, k, f, packed.training(f)[1]) for k in range(p.n_estimators)] for p, f in jobs]
    room = max(1, pass_rows // (d * SPLITS))
    rows = sum(s[0] for s in packed.folds.values())
    for random_cuts, cuts in ((False, _best_cuts), (True, _random_cuts)):
        # smaller leaves first: others take their cuts over
        trees = sorted((t for forest in forests for t in forest if t.params.random_cuts == random_cuts), key=lambda t: t.params.min_samples_leaf)
        while True:
            work, left, seen, borrowed = [], room, {}, []
            # deep nodes hold few rows, so that their sums are few too: a level of one tree has no more than its rows' sums
            for t in trees:
                if t.open and left > 0:
                    take = t.open[:max(left, 1)] if rows * d > pass_rows else t.open
                    t.open = t.open[len(take):]
                    if t.params.plain(d):
                        borrowed += [(t, n, (t.held_out, t.path[n])) for n in take if n not in t.alone and (t.held_out, t.path[n]) in seen]
                        take = [n for n in take if n in t.alone or (t.held_out, t.path[n]) not in seen]
                        seen.update({(t.held_out, t.path[n]): None for n in take if n not in t.alone})
                    if take:
                        work.append((t, take))
                        left -= min(len(take), max(1, rows // SPLITS))
            if not work:
                break
            for (t, nodes), found in zip(work, cuts(packed.table, work, d)):
                for node in nodes:
                    if t.params.plain(d) and node not in t.alone:
                        seen[t.held_out, t.path[node]] = found[node]
                    _take(t, node, found[node])
            for t, node, key in borrowed:
                _, f, _, a, b, _ = seen[key]
                if f < 0 or min(a[0], b[0]) >= t.params.min_samples_leaf:
                    _take(t, node, seen[key])
                else:
                    t.alone.add(node)
                    t.open.append(node)
            for t in trees:
                if t.params.plain(d):
                    far = lambda n: t.params.max_depth is None or t.params.max_depth - t.level[n] >= LOCAL_LEVELS  # noqa: E731,B023
                    ready = {n for n in t.open if n and t.rows[n] <= local_rows and far(n)}
                    t.local += sorted(ready)
                    t.open = [n for n in t.open if n not in ready]
    return forests


def _take(t: Growing, node: int, found) -> None:
    gain, f, threshold, a, b, (n, s) = found
    if node == 0:
        t.rows[0], t.value[0] = float(n), float(t.base + (s / n if n else 0.0))
        if not t.may_split(0):
            return
    if f >= 0:
        t.split(node, f, threshold, gain, a, b)


def model_of(packed: B.Blocks, forest: list[Growing], depth: int | None = None, prediction_col: str = "prediction", min_split: int = 0) -> TreesModel:
    """The mean of the trees, cut at a depth: a tree of smaller ``max_depth`` is the upper part of a deeper one."""
    return TreesModel(packed.features, [t.cut_at(depth, min_split) for t in forest], 0.0, prediction_col, "mean")


def score(packed: B.Blocks, entries) -> list[tuple]:
    """(n, rmse, mae, r2) on the held-out fold of each entry (trees, depth or None, fewest rows of a node that is cut), in one pass, and
    one over the rows of nodes left to tasks."""
    told = packed.table.sparkSession.sparkContext.broadcast(
        [(forest[0].held_out, [(np.isin(np.arange(len(t.feature)), _elsewhere(t, depth, split)),
                                *(np.array(c[k]) for k in ("feature", "threshold", "left", "right", "value"))) for t in forest for c in (t.cut_at(depth, split),)])
         for forest, depth, split in entries])

    def run(batches):
        sums = np.zeros((len(told.value), 3))
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                for m, (held_out, trees) in enumerate(told.value):
                    rows = np.flatnonzero(block["fold"] == held_out)
                    x = block["x"][:, rows]
                    total, here = np.zeros(len(rows)), np.ones(len(rows), bool)
                    for elsewhere, *nodes, value in trees:
                        leaf = walk(x, *nodes)
                        total += value[leaf]
                        here &= ~elsewhere[leaf]
                    e = (total / len(trees) - block["y"][rows])[here]
                    sums[m] += len(e), (e * e).sum(), np.abs(e).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32())] + [pa.array(sums[:, k]) for k in range(3)], ["model", "n", "sse", "sae"])

    got = packed.table.mapInArrow(run, "model int, n double, sse double, sae double").groupBy("model").sum("n", "sse", "sae").collect()
    out, held = {}, [(_Held(forest), depth, split) for forest, depth, split in entries]
    more = subtrees.finish(packed, held, raw=True)
    for m, *sums in got:
        n, sse, sae = map(float, more[m] + sums if m in more else sums)
        sst = packed.folds[entries[m][0][0].held_out][2]
        out[m] = (int(n), math.sqrt(sse / n), sae / n, 1 - sse / sst if sst > 0 else float(sse == 0))
    return [out[m] for m in range(len(entries))]


def _elsewhere(t: Growing, depth: int | None, split: int) -> list[int]:
    """The nodes left to tasks that a part of the tree would cut."""
    return [n for n in t.local if (depth is None or t.level[n] < depth) and t.rows[n] >= split]


class _Held:
    """A forest as :func:`subtrees.finish` takes it."""

    def __init__(self, trees):
        self.trees, self.held_out = trees, trees[0].held_out


def forest_params(family: str, params: dict) -> ForestParams:
    """Parameters of a family by the reference's names."""
    base = {"exact_tree": ForestParams(), "exact_forest": ForestParams(100, bootstrap=True),
            "random_cut_trees": ForestParams(100, random_cuts=True)}[family]
    return replace(base, **params)


def fit(df: DataFrame, features, target: str, params: ForestParams, prediction_col: str = "prediction", on_null: str = "error") -> TreesModel:
    """One forest on all rows."""
    packed = B.pack(df, features, target, raw=True, on_null=on_null)
    try:
        return model_of(packed, grow(packed, [(params, None)])[0], None, prediction_col)
    finally:
        B.discard(packed.table)


def cross_validate(df: DataFrame, candidates, features, target: str, fold_col: str, on_null: str = "error", keep: dict | None = None,
                   packs=None) -> list[tuple]:
    """(name, fold, n, rmse, mae, r2) of candidates (name, params); settings that differ in ``max_depth`` only grow once, and in
    ``min_samples_split`` where nothing is drawn.  ``keep`` receives every fold model as (name, fold) -> model; ``packs`` holds blocks for several calls."""
    with B.Packs.of(packs, df, features, target, fold_col, on_null) as packs:
        packed = packs.get(fold_col, raw=True)
        folds, jobs, d = sorted(packed.folds), {}, len(packed.features)
        # draws go by the numbers of nodes, so only trees without draws are parts of one another by their smallest cut nodes
        shape = lambda p: replace(p, max_depth=None, min_samples_split=0 if p.plain(d) else p.min_samples_split)
        for name, p in candidates:
            # depths and splits of a group of settings: the deepest tree is grown
            jobs.setdefault(shape(p), []).append(p)
        deepest = {s: replace(s, max_depth=None if any(p.max_depth is None for p in ps) else max(p.max_depth for p in ps),
                              min_samples_split=min(p.min_samples_split for p in ps)) for s, ps in jobs.items()}
        order = [(p, f) for p in jobs for f in folds]
        forests = grow(packed, [(deepest[p], f) for p, f in order], local_rows=LOCAL_ROWS if keep is None else 0)
        grown = dict(zip(order, forests))
        entries = [(name, f, (grown[shape(p), f], p.max_depth, max(2, p.min_samples_split) if p.plain(d) else 0)) for name, p in candidates for f in folds]
        if keep is not None:
            for name, f, (trees, depth, split) in entries:
                keep[name, f] = PipelineModel([model_of(packed, trees, depth, "__p", split)])
        return [(name, f, *m) for (name, f, _), m in zip(entries, score(packed, [e for _, _, e in entries]))]
