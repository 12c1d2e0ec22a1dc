"""Random forests of several configurations, grown and scored inside tasks (M2).

The learner is that of Spark ML's forests: features in at most 32 bins of training quantiles, a Poisson(1) draw of every
row per tree, a random subset of sqrt(features) per node, Gini gain with weighted classes, at least ``min_samples_leaf``
drawn rows in a child, sibling leaves of one prediction merged, and the mean of the trees' class shares as the score. Draws
are hashes of (tree, row) and (tree, node), so a retried task repeats them and no result depends on the partitions.

A tree is grown level by level in numpy, all nodes of a level in one step, from counts per (node, feature, bin). Trees are
never collected: the task that grows one drops the evaluation rows down it and only sums of class shares leave the task.

1. While a node has more than ``NODE_ROWS`` rows, a pass over all rows sums the counts of such nodes of all trees, one
   shuffle adds them up and the tasks behind it pick the splits. One row per such node reaches the driver.
2. A tree that begins with fewer rows shares its task with other trees of its configuration: the rows are dealt to
   ``GROUPS`` groups of trees a core. Of larger trees each node that step 1 ended at is a group of its own, which gets its
   drawn rows and its evaluation rows.

Nodes above ``NODE_ROWS`` are not merged with a sibling. Rows that are equal in id, features and label share their draws.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import written
from hourglass.llm.text import mix
from hourglass.plans import boosting

MAX_BINS = 32
BINS = MAX_BINS + 1  # missing values are the last one, right of every cut
UNLIMITED_DEPTH = 30
#: Training rows of a node that one task finishes, at most.
NODE_ROWS = 400_000
#: Groups of trees for every core.
GROUPS = 8
#: Counts of a pass that a map task holds, at most.
PASS_CELLS = 4_000_000
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate(([1.0], np.arange(1.0, 16.0)))))
#: A pair of counts (rows, positive rows) in one exact double.
_PAIR = float(1 << 26)


@dataclass(frozen=True)
class Config:
    """One forest."""

    n_estimators: int
    max_depth: int | None = None
    min_samples_leaf: int = 1
    balanced: bool = False
    seed: int = 42

    @property
    def depth(self) -> int:
        return self.max_depth or UNLIMITED_DEPTH


def drawn(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree draws every row: Poisson(1) by a hash."""
    salt = mix(np.array([(seed << 32) + tree + 1], np.uint64))
    u = (mix(keys ^ salt) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.searchsorted(_POISSON, u, side="right")


def root(seed: int, tree: int) -> np.ndarray:
    """The name of a tree's root; :func:`below` names the children."""
    return mix(np.array([(seed << 33) + 2 * tree + 1], np.uint64))


def below(names: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(names * np.uint64(2) + right.astype(np.uint64))


def chosen(names: np.ndarray, n_features: int, n: int) -> np.ndarray:
    """``n`` features (ascending) of every node."""
    if n >= n_features:
        return np.tile(np.arange(n_features), (len(names), 1))
    rank = mix(names[:, None] ^ mix(np.arange(1, n_features + 1, dtype=np.uint64))[None, :])
    return np.sort(np.argpartition(rank, n - 1, axis=1)[:, :n], axis=1)


def cells(slot: np.ndarray, codes: np.ndarray, used: np.ndarray, y: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(cell, rows, positive rows)`` of the cells (node's place, place of the feature in ``used``, bin) with rows."""
    width = used.shape[1]
    at = ((slot[:, None] * width + np.arange(width)) * BINS + codes[np.arange(len(codes))[:, None], used[slot]]).ravel()
    pair = np.repeat(count + _PAIR * (count * y), width)
    if len(used) * width * BINS <= 2 * len(at):
        sums = np.bincount(at, pair, len(used) * width * BINS)
        cell = np.flatnonzero(sums)
        sums = sums[cell]
    else:
        order = np.argsort(at)
        at = at[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        cell, sums = at[first], np.add.reduceat(pair[order], first)
    ones = np.floor(sums / _PAIR)
    return cell, sums - ones * _PAIR, ones


def best_splits(cell, n, ones, n_nodes: int, width: int, weights: tuple[float, float], least: int) -> tuple[np.ndarray, ...]:
    """``(place of the feature or -1, cut, left n, left ones)`` per node, from all cells of the nodes in order.

    Ties go to the smaller feature, then the smaller cut."""
    group = cell // BINS  # (node, feature)
    start = np.concatenate(([True], group[1:] != group[:-1]))
    first = np.flatnonzero(start)
    which = np.cumsum(start) - 1
    run_n, run_ones = np.cumsum(n), np.cumsum(ones)
    all_n, all_ones = np.add.reduceat(n, first)[which], np.add.reduceat(ones, first)[which]
    left_n = run_n - (run_n[first] - n[first])[which]
    left_ones = run_ones - (run_ones[first] - ones[first])[which]

    def spread(k, k1):
        """Weight times Gini impurity, and the weight."""
        w1, w0 = weights[1] * k1, weights[0] * (k - k1)
        w = w0 + w1
        return np.divide(2 * w0 * w1, w, out=np.zeros_like(w), where=w > 0), w

    whole, w = spread(all_n, all_ones)
    gain = (whole - spread(left_n, left_ones)[0] - spread(all_n - left_n, all_ones - left_ones)[0]) / w
    right_n = all_n - left_n
    gain = np.where((left_n >= least) & (right_n >= max(1, least)), np.round(gain, 12), 0.0)
    node = group // width
    ahead = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    top = np.maximum.reduceat(gain, ahead)
    count = np.diff(np.concatenate((ahead, [len(node)])))
    hits = np.flatnonzero(gain == np.repeat(top, count))
    best = hits[np.searchsorted(hits, ahead)]
    feature, cut = np.full(n_nodes, -1), np.zeros(n_nodes, np.int64)
    ln, l1 = np.zeros(n_nodes), np.zeros(n_nodes)
    splits = top > 0
    at, best = node[ahead][splits], best[splits]
    feature[at], cut[at], ln[at], l1[at] = group[best] % width, cell[best] % BINS, left_n[best], left_ones[best]
    return feature, cut, ln, l1


class Tree:
    """A tree over binned features; node 0 is where it begins, ``left`` is -1 in a leaf and the right child is ``left`` + 1."""

    def __init__(self, codes, y, count, name: np.ndarray, depth: int, config: Config, weights: tuple[float, float], n_used: int):
        least, total = config.min_samples_leaf, float(count.sum())
        slot, names = np.zeros(len(codes), np.int64), name
        n, ones = np.array([total]), np.array([float((count * y).sum())])
        node, size = np.zeros(1, np.int64), 1  # the level's open nodes in the tree
        parts = [(n, ones)]
        splits: list[tuple[np.ndarray, ...]] = []  # per level: node, feature, cut, left child
        while depth < config.depth and len(node) and len(codes):
            used = chosen(names, codes.shape[1], n_used)
            feature, cut, ln, l1 = best_splits(*cells(slot, codes, used, y, count), len(node), used.shape[1], weights, least)
            split = np.flatnonzero(feature >= 0)
            if not len(split):
                break
            depth += 1
            column = used[np.arange(len(node)), np.maximum(feature, 0)]
            child = np.full(len(node), -1)
            child[split] = size + 2 * np.arange(len(split))
            splits.append((node[split], column[split], cut[split], child[split]))
            kids_n = np.stack([ln[split], n[split] - ln[split]], 1).ravel()
            kids_1 = np.stack([l1[split], ones[split] - l1[split]], 1).ravel()
            parts.append((kids_n, kids_1))
            # a pure child, or one with too few rows for two children, stays a leaf
            goes = (kids_1 > 0) & (kids_1 < kids_n) & (kids_n >= 2 * max(1, least))
            place = np.where(goes, np.cumsum(goes) - 1, -1)
            right = codes[np.arange(len(codes)), column[slot]] > cut[slot]
            kid = child[slot] - size + right
            to = np.where(child[slot] >= 0, place[np.maximum(kid, 0)], -1)
            stay = np.flatnonzero(to >= 0)
            codes, y, count, slot = codes[stay], y[stay], count[stay], to[stay]
            names = below(np.repeat(names[split], 2), np.tile([0, 1], len(split)))[goes]
            n, ones, node = kids_n[goes], kids_1[goes], (size + np.arange(2 * len(split)))[goes]
            size += 2 * len(split)
        n, ones = (np.concatenate(x) for x in zip(*parts, strict=True))
        w1, w0 = weights[1] * ones, weights[0] * (n - ones)
        self.share = np.divide(w1, w0 + w1, out=np.zeros(size), where=w0 + w1 > 0)
        self.feature, self.cut, self.left = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1)
        says = w1 > w0
        for at, column, cut, child in splits:
            self.feature[at], self.cut[at], self.left[at] = column, cut, child
        for at, _, _, child in reversed(splits):
            same = (self.left[child] < 0) & (self.left[child + 1] < 0) & (says[child] == says[child + 1])
            self.left[at[same]] = -1

    def shares(self, codes: np.ndarray) -> np.ndarray:
        """The share of class 1 in the leaf of every row."""
        at, open_ = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while len(open_):
            here = at[open_]
            inner = self.left[here] >= 0
            open_, here = open_[inner], here[inner]
            at[open_] = self.left[here] + (codes[open_, self.feature[here]] > self.cut[here])
        return self.share[at]


# ------------------------------------------------------------------ nodes with many rows
@dataclass
class Top:
    """The part of a large tree that passes have grown."""

    config: int
    tree: int
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    names: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=lambda: [0])
    open: list[int] = field(default_factory=lambda: [0])

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        feature, cut, left = (np.asarray(x) for x in (self.feature, self.cut, self.left))
        at = np.zeros(len(codes), np.int64)
        for _ in range(max(self.depths)):
            go = left[at] >= 0
            at = np.where(go, left[at] + (codes[np.arange(len(codes)), np.maximum(feature[at], 0)] > cut[at]), at)
        return at

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.left)
        names = below(np.array([self.names[node]] * 2, np.uint64), np.array([0, 1]))
        for name in names.tolist():
            for x, v in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.names, name), (self.depths, self.depths[node] + 1)):
                x.append(v)
        return self.left[node], self.left[node] + 1


def _codes(column: pa.Array, n_features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), n_features)


def _pass(train: DataFrame, tops: list[tuple[int, Top]], configs, weights, n_features: int, n_used: int) -> list:
    """The best split of every open node of ``tops`` (with their numbers)."""
    plan = [(i, t, np.asarray(t.open), chosen(np.asarray([t.names[o] for o in t.open], np.uint64), n_features, n_used)) for i, t in tops]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            key, y, codes = b.column(0).to_numpy().astype(np.uint64), b.column(1).to_numpy(), _codes(b.column(2), n_features)
            for i, t, nodes, used in plan:
                times = drawn(key, configs[t.config].seed, t.tree)
                place = np.full(len(t.left), -1)
                place[nodes] = np.arange(len(nodes))
                slot = place[t.nodes(codes)]
                take = np.flatnonzero((slot >= 0) & (times > 0))
                if not len(take):
                    continue
                at, n, ones = cells(slot[take], codes[take], used, y[take], times[take])
                held = sums.setdefault(i, np.zeros((2, len(nodes) * used.shape[1] * BINS)))
                held[0, at] += n
                held[1, at] += ones
        for i, held in sums.items():
            at = np.flatnonzero(held[0])
            size = n_used * BINS
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)),
                 pa.array(held[0, at]), pa.array(held[1, at])], names=["top", "place", "cell", "n", "ones"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        whole = pa.Table.from_batches(parts)
        top, place, cell, n, ones = (whole[c].to_numpy() for c in ("top", "place", "cell", "n", "ones"))
        change = np.flatnonzero(np.concatenate(([True], (np.diff(top) != 0) | (np.diff(place) != 0), [True])))
        out: list[tuple] = []
        for lo, hi in zip(change[:-1], change[1:], strict=True):
            c = of[int(top[lo])]
            feature, cut, ln, l1 = best_splits(cell[lo:hi].astype(np.int64), n[lo:hi], ones[lo:hi], 1, n_used, weights[c],
                                               configs[c].min_samples_leaf)
            one = cell[lo:hi] // BINS == cell[lo] // BINS
            out.append((int(top[lo]), int(place[lo]), int(feature[0]), int(cut[0]), float(n[lo:hi][one].sum()), float(ones[lo:hi][one].sum()),
                        float(ln[0]), float(l1[0])))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32()] * 4 + [pa.float64()] * 4, strict=True)],
                                         names=["top", "place", "feature", "cut", "n", "ones", "ln", "l1"])

    of = {i: t.config for i, t in tops}
    sums = train.mapInArrow(count, "top int, place int, cell int, n double, ones double")
    whole = sums.groupBy("top", "place", "cell").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    tasks = max(1, min(sum(len(t.open) for _, t in tops), 2 * train.sparkSession.sparkContext.defaultParallelism))
    return whole.repartition(tasks, "top", "place").sortWithinPartitions("top", "place", "cell").mapInArrow(
        pick, "top int, place int, feature int, cut int, n double, ones double, ln double, l1 double").collect()


def _tops(train: DataFrame, configs, weights, n_features: int, n_used: int) -> list[Top]:
    """The trees down to nodes of at most ``NODE_ROWS`` rows."""
    tops = [Top(c, t, names=root(x.seed, t).tolist()) for c, x in enumerate(configs) for t in range(x.n_estimators)]
    while any(t.open for t in tops):
        todo, after = [(i, t) for i, t in enumerate(tops) if t.open], {}
        while todo:
            some, size = [], 0
            while todo and (not some or size + len(todo[0][1].open) * n_used * BINS <= PASS_CELLS):
                size += len(todo[0][1].open) * n_used * BINS
                some.append(todo.pop(0))
            for r in _pass(train, some, configs, weights, n_features, n_used):
                t = tops[r.top]
                after.setdefault(r.top, [])
                if r.feature < 0:
                    continue
                node = t.open[r.place]
                used = chosen(np.asarray([t.names[node]], np.uint64), n_features, n_used)[0]
                kids = t.split(node, int(used[r.feature]), r.cut)
                for kid, n, ones in zip(kids, (r.ln, r.n - r.ln), (r.l1, r.ones - r.l1), strict=True):
                    if n > NODE_ROWS and 0 < ones < n and t.depths[kid] < configs[t.config].depth:
                        after[r.top].append(kid)
        for i, t in enumerate(tops):
            t.open = sorted(after.get(i, []))
    return tops


# ------------------------------------------------------------------ fitting and scoring
_DEALT = "grp int, kind int, key binary, y binary, codes binary"
_SUMS = "config int, row long, total double, trees int"


def _dealt(df: DataFrame, kind: int, n_features: int, groups: int, tops: list[Top] | None, numbers, configs) -> DataFrame:
    """Packed rows (``key``, ``y``, ``codes``) of every group; training rows (``kind`` 0) of a large tree's node are those
    that the tree draws."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            key, y, codes = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.uint8), _codes(b.column(2), n_features)
            if tops is None:
                whole = [x.tobytes() for x in (key, y, codes)]
                for g in range(groups):
                    yield _one_row(g, kind, whole)
                continue
            for i, t in enumerate(tops):
                take = np.arange(len(key)) if kind else np.flatnonzero(drawn(key.astype(np.uint64), configs[t.config].seed, t.tree))
                node = t.nodes(codes[take])
                for k in np.unique(node):
                    rows = take[node == k]
                    yield _one_row(numbers[i, int(k)], kind, [x[rows].tobytes() for x in (key, y, codes)])

    return df.mapInArrow(run, _DEALT)


def _one_row(group: int, kind: int, packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([kind], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]],
                                      names=["grp", "kind", "key", "y", "codes"])


def scores(train: DataFrame, ev: DataFrame, features: list[str], configs: list[Config], label: str, id_col: str,
           keep: list[str]) -> DataFrame:
    """``config``, ``keep`` and ``y_prob`` (mean share of class 1) of every row of ``ev`` and every forest fitted on the
    rows of ``train`` with a label."""
    spark = train.sparkSession
    cores = spark.sparkContext.defaultParallelism
    rows = train.where(F.col(label).isNotNull())
    edges = boosting.bin_edges(rows, features, MAX_BINS)
    key = F.xxhash64(id_col, label, *features)
    n_features, n_used = len(features), int(np.ceil(np.sqrt(len(features))))
    by_class = {int(r["y"]): r["n"] for r in rows.groupBy(F.col(label).cast("int").alias("y")).count().withColumnRenamed("count", "n").collect()}
    n_train = sum(by_class.values())
    if not n_train:
        raise ValueError("a forest needs training rows")
    if not set(by_class) <= {0, 1}:
        raise ValueError(f"classes 0 and 1, not {sorted(by_class)}")
    weights = [tuple(n_train / (2 * by_class[y]) if by_class.get(y) else 0.0 for y in (0, 1)) if c.balanced else (1.0, 1.0) for c in configs]

    def stored(df: DataFrame, key, y, name: str, also=()) -> DataFrame:
        """Written with the bins' codes, missing values after all others."""
        coded = boosting.binned(df.select(key.alias("_key"), y.alias("_y"), *[F.col(c).alias(f"_keep_{c}") for c in also], *features),
                                features, edges, ["_key", "_y", *[f"_keep_{c}" for c in also]])
        return written(coded, name)

    fitting = stored(rows, key, F.col(label).cast("int"), "forest-train").select("_key", "_y", "bins")
    numbered = written(ev.select(*keep, *[F.col(c).cast("double").alias(c) for c in features if c not in keep],
                                 F.monotonically_increasing_id().alias("_row")), "forest-rows")
    asked = stored(numbered, F.col("_row"), F.lit(0), "forest-eval").select("_key", "_y", "bins")
    # bins are at most 32 codes; a missing value is the last
    packed = [_with_missing_last(x, n_features) for x in (fitting, asked)]
    large = n_train > NODE_ROWS
    tops = _tops(packed[0], configs, weights, n_features, n_used) if large else None
    if large:
        units = [(i, k) for i, t in enumerate(tops) for k in range(len(t.left)) if t.left[k] < 0]
        plan = [(tops[i].config, [tops[i].tree], int(tops[i].names[k]), tops[i].depths[k]) for i, k in units]
    else:
        each = max(1, -(-GROUPS * cores // len(configs)))
        plan = [(c, list(range(g, x.n_estimators, each)), None, 0) for c, x in enumerate(configs) for g in range(min(each, x.n_estimators))]
    numbers = {u: g for g, u in enumerate(units)} if large else {}
    dealt = [_dealt(x, kind, n_features, len(plan), tops, numbers, configs) for kind, x in enumerate(packed)]
    tasks = len(plan) if not large else min(len(plan), max(8 * cores, sum(x.n_estimators for x in configs) * n_train // (4 * NODE_ROWS)))
    together = dealt[0].unionByName(dealt[1]).repartitionById(tasks, F.pmod("grp", F.lit(tasks)).cast("int")).sortWithinPartitions("grp", "kind")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(g: int, held) -> pa.RecordBatch:
            c, trees, name, depth = plan[g]
            x = configs[c]
            (key, y, codes), (ids, _, asked_codes) = [
                (np.frombuffer(b"".join(p[0] for p in parts), np.int64), np.frombuffer(b"".join(p[1] for p in parts), np.uint8).astype(float),
                 np.frombuffer(b"".join(p[2] for p in parts), np.uint8).reshape(-1, n_features)) for parts in held]
            total = np.zeros(len(ids))
            for t in trees if len(ids) else ():
                times = drawn(key.astype(np.uint64), x.seed, t)
                take = np.flatnonzero(times)
                begin = root(x.seed, t) if name is None else np.array([name], np.uint64)
                total += Tree(codes[take], y[take], times[take].astype(float), begin, depth, x, weights[c], n_used).shares(asked_codes)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), c, np.int32)), pa.array(ids), pa.array(total),
                                               pa.array(np.full(len(ids), len(trees), np.int32))], names=["config", "row", "total", "trees"])

        at, held = None, ([], [])
        for b in batches:
            for g, kind, *part in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if g != at:
                    if at is not None:
                        yield done(at, held)
                    at, held = g, ([], [])
                held[kind].append(part)
        if at is not None:
            yield done(at, held)

    sums = together.mapInArrow(grow, _SUMS)
    # rounded, so that the order of the sums over groups does not tell equal scores apart
    probs = written(sums.groupBy("config", "row").agg(F.round(F.sum("total") / F.sum("trees"), 12).alias("y_prob")), "forest-scores")
    return probs.join(numbered.select(F.col("_row").alias("row"), *keep), "row").select("config", *keep, "y_prob")


def _with_missing_last(df: DataFrame, n_features: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = np.minimum(_codes(b.column(2), n_features), BINS - 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary())], names=b.schema.names)

    return df.mapInArrow(run, df.schema)
