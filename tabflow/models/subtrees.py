"""Subtrees grown to their end in one task each, for trees whose upper levels were grown by passes over all rows.

The rows of a node, training and held-out ones, are shuffled to one task by the node's path; a node that several settings reach by the
same tests is sent once.  There the subtree of every setting is grown level by level over the values in order (exact cuts; over byte bins the same
are the cuts between bins), and the held-out rows are scored at every wanted depth: neither rows nor trees reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from tabflow.models import blocks as B
from tabflow.models.boosting import walk

DENSE = 4     # cells a row up to which they are counted one by one


def below(path: int, *test) -> int:
    """A number for the path that goes on by a test."""
    return int.from_bytes(hashlib.blake2b(repr((path, *test)).encode(), digest_size=8).digest(), "little") >> 1


def _runs(key: np.ndarray, g: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, their rows and sums: counted by cell where there are few cells, sorted otherwise."""
    if cells <= DENSE * len(key):
        n = np.bincount(key, minlength=cells)
        found = np.flatnonzero(n)
        return found, n.take(found).astype(float), np.bincount(key, g, cells).take(found)
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[start], np.diff(np.concatenate((start, [len(key)]))).astype(float), np.add.reduceat(g[order], start)


def grow_sorted(x: np.ndarray, g: np.ndarray, depth: int, min_leaf: int, min_split: int = 2, midpoints: bool = False) -> dict:
    """A tree over the columns of ``x`` (features, rows) and the target ``g``: arrays feature, threshold, left, right, value, rows."""
    d, n = x.shape
    ranks, values = [], []
    for f in range(d):
        v, r = np.unique(x[f], return_inverse=True)
        values.append(v)
        ranks.append(r.astype(np.int64))
    nodes = {"feature": [np.array([-1])], "threshold": [np.zeros(1)], "left": [np.zeros(1, np.int64)], "right": [np.zeros(1, np.int64)],
             "value": [np.array([g.mean()])], "rows": [np.array([n])]}
    rows, slot, ids, count, total = np.arange(n), np.zeros(n, np.int64), np.zeros(1, np.int64), np.array([n], float), np.array([g.sum()])
    made, need = 1, max(2, min_split, 2 * min_leaf)
    if n < need:
        depth = 0
    for _ in range(depth):
        k = len(ids)
        g_rows = g.take(rows)
        square = np.bincount(slot, g_rows ** 2, k)
        best, feature, left_rank, following = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64), np.zeros(k, np.int64)
        left_n, left_s = np.zeros(k), np.zeros(k)
        first = np.concatenate(([0], np.cumsum(np.bincount(slot, minlength=k))[:-1])).astype(np.int64)
        whole = total * total / count
        for f in range(d):
            key, n_key, s_key = _runs(slot * len(values[f]) + ranks[f].take(rows), g_rows, k * len(values[f]))
            of = key // len(values[f])
            at = np.flatnonzero(of[1:] == of[:-1])
            if not len(at):
                continue
            s = of[at]
            sums = np.cumsum(s_key)
            before = np.searchsorted(of, s)
            nl = np.cumsum(n_key)[at] - first[s]
            sl = sums[at] - np.where(before > 0, sums[before - 1], 0)
            nr, sr = count[s] - nl, total[s] - sl
            ok = (nl >= min_leaf) & (nr >= min_leaf)
            at, s, nl, sl, nr, sr = at[ok], s[ok], nl[ok], sl[ok], nr[ok], sr[ok]
            if not len(at):
                continue
            gain = sl * sl / nl + sr * sr / nr - whole[s]
            start = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            top = np.maximum.reduceat(gain, start)
            near = np.flatnonzero(gain >= np.repeat(top - 1e-12 * np.abs(top), np.diff(np.concatenate((start, [len(s)])))))
            near = near[np.concatenate(([True], s[near][1:] != s[near][:-1]))]        # the lowest threshold of each node
            better = near[gain[near] > best[s[near]] * (1 + 1e-12) + 1e-12 * np.maximum(1, square[s[near]])]
            w = s[better]
            best[w], feature[w], left_n[w], left_s[w] = gain[better], f, nl[better], sl[better]
            left_rank[w], following[w] = key[at[better]] % len(values[f]), key[at[better] + 1] % len(values[f])
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        threshold = np.zeros(k)
        for f in range(d):
            of = split[feature[split] == f]
            low, high = values[f][left_rank[of]], values[f][following[of]]
            if midpoints:
                middle = low + (high - low) / 2
                low = np.where(middle < high, middle, low)
            threshold[of] = low
        child = np.full(k, -1)
        child[split] = 2 * np.arange(len(split))
        m = 2 * len(split)
        n_child, s_child = np.zeros(m), np.zeros(m)
        n_child[0::2], s_child[0::2] = left_n[split], left_s[split]
        n_child[1::2], s_child[1::2] = (count - left_n)[split], (total - left_s)[split]
        # the parents' entries lie in the last level's arrays
        place = ids[split] - (made - len(nodes["feature"][-1]))
        nodes["feature"][-1][place], nodes["threshold"][-1][place] = feature[split], threshold[split]
        nodes["left"][-1][place], nodes["right"][-1][place] = made + child[split], made + child[split] + 1
        for name, column in (("feature", np.full(m, -1)), ("threshold", np.zeros(m)), ("left", np.zeros(m, np.int64)), ("right", np.zeros(m, np.int64)),
                             ("value", s_child / n_child), ("rows", n_child)):
            nodes[name].append(column)
        kept = child[slot] >= 0
        rows, slot = rows[kept], slot[kept]
        rank = np.empty(len(rows), np.int64)
        for f in range(d):
            of = np.flatnonzero(feature[slot] == f)
            rank[of] = ranks[f][rows[of]]
        to = child[slot] + (rank > left_rank[slot])
        open_ = np.flatnonzero(n_child >= need)
        renumber = np.full(m, -1)
        renumber[open_] = np.arange(len(open_))
        slot = renumber[to]
        rows, slot = rows[slot >= 0], slot[slot >= 0]
        ids, count, total, made = made + open_, n_child[open_], s_child[open_], made + m
        if not len(ids):
            break
    return {name: np.concatenate(parts) for name, parts in nodes.items()}


def values_at(tree: dict, x: np.ndarray, depths, min_split: int = 0) -> dict:
    """{depth: predictions} of the tree's upper parts; nodes of fewer than ``min_split`` rows are leaves."""
    inner = (tree["feature"] >= 0) & (tree["rows"] >= min_split)
    node, out, columns = np.zeros(x.shape[1], np.int64), {}, np.arange(x.shape[1])
    for step in range(max(depths) + 1):
        if step in depths:
            out[step] = tree["value"][node]
        go = np.flatnonzero(inner[node])
        if not len(go):
            break
        at = node[go]
        node[go] = np.where(x[tree["feature"][at], columns[go]] <= tree["threshold"][at], tree["left"][at], tree["right"][at])
    for step in depths:
        out.setdefault(step, tree["value"][node])
    return out


def finish(packed: B.Blocks, entries, raw: bool = False) -> dict:
    """{entry: sums of rows, squared and absolute errors} over the held-out rows in nodes left to tasks; entries (grown, depth or None)
    or (grown, depth, min_split).  ``raw``: cut the values themselves, between neighbours."""
    by_key, senders = {}, {}
    for m, (grown, depth, *more) in enumerate(entries):
        t = grown.trees[0]
        for node in t.local:
            # a leaf of this part of the tree
            if depth is not None and t.level[node] >= depth or more and t.rows[node] < more[0]:
                continue
            key = (grown.held_out, t.path[node])
            number, jobs = by_key.setdefault(key, (len(by_key), []))
            jobs.append((m, None if depth is None else depth - t.level[node], *t.rule(), *(more or (0,))))
            if len(jobs) == 1:
                senders.setdefault(id(t), (t, {}))[1][node] = number
    if not by_key:
        return {}
    kind = np.float64 if raw else np.uint8
    told = packed.table.sparkSession.sparkContext.broadcast([(t.held_out, t.arrays(), wanted) for t, wanted in senders.values()])
    todo = packed.table.sparkSession.sparkContext.broadcast({number: jobs for number, jobs in by_key.values()})
    base = packed.training(None)[1]

    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = B.unpacked(batch, i)
                x = block["x" if raw else "bins"]
                keys, parts = [], []
                for held_out, nodes, wanted in told.value:
                    numbers = np.full(len(nodes[0]), -1)
                    numbers[list(wanted)] = list(wanted.values())
                    number = numbers[walk(x, *nodes)]
                    rows = np.flatnonzero(number >= 0)
                    rows = rows[np.argsort(number[rows], kind="stable")]
                    for part in np.split(rows, np.flatnonzero(np.diff(number[rows])) + 1):
                        if len(part):
                            keys.append(int(number[part[0]]))
                            parts.append((x[:, part].tobytes(), block["y"][part].tobytes(), (block["fold"][part] != held_out).tobytes()))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), *[pa.array([p[k] for p in parts], pa.binary()) for k in range(3)]],
                                                     ["number", "x", "y", "used"])

    def grown_here(table):
        number = table.column("number")[0].as_py()
        y = np.concatenate([np.frombuffer(v) for v in table.column("y").to_pylist()]) - base
        used = np.concatenate([np.frombuffer(v, bool) for v in table.column("used").to_pylist()])
        x = np.concatenate([np.frombuffer(v, kind).reshape(-1, len(z) // 8) for v, z in zip(table.column("x").to_pylist(), table.column("y").to_pylist())], axis=1)
        train, g, held, truth = np.ascontiguousarray(x[:, used]), y[used], np.ascontiguousarray(x[:, ~used]), y[~used]
        del x, table
        groups, sums = {}, []
        for m, depth, leaf, split, cut in todo.value[number]:
            groups.setdefault(leaf, []).append((m, depth, max(split, cut)))
        for leaf, jobs in groups.items():
            if not len(truth):
                continue
            # no tree of n rows is deeper than n
            far = lambda depth: len(g) if depth is None else depth
            tree = grow_sorted(train, g, max(far(j[1]) for j in jobs), leaf, min(j[2] for j in jobs), raw)
            for split in {j[2] for j in jobs}:
                found = values_at(tree, held, {far(j[1]) for j in jobs if j[2] == split}, split)
                for m, depth, s in jobs:
                    if s == split:
                        e = found[far(depth)] - truth
                        sums.append((m, float(len(e)), float((e * e).sum()), float(np.abs(e).sum())))
        return pa.table({name: pa.array([s[k] for s in sums], t) for k, (name, t) in enumerate(
            (("model", pa.int32()), ("n", pa.float64()), ("sse", pa.float64()), ("sae", pa.float64())))})

    sent = packed.table.mapInArrow(send, "number int, x binary, y binary, used binary")
    got = (sent.groupBy("number").applyInArrow(grown_here, "model int, n double, sse double, sae double").groupBy("model").sum("n", "sse", "sae").collect())
    told.unpersist()
    todo.unpersist()
    return {m: np.array([n, sse, sae]) for m, n, sse, sae in got}
