"""Histogram boosting of several configurations over shared scans.

Features are binned once. Every pass over the rows then serves *every* configuration (and every label budget). For the
nodes that hold many rows it serves one tree level: tasks sum gradients and Hessians per (config, tree node, feature, bin)
in numpy, one shuffle adds the partial sums up, and the tasks behind it pick the best split of each node by second-order
gain. A node whose rows take at most ``NODE_BYTES`` is finished in the same pass: its rows (bins, gradients, Hessians) are
grouped by (config, node) and the task behind the shuffle grows all levels below it by the same sums and splits. So a
round takes as many passes as its tree has levels of large nodes, and one more. The driver only sees one row per split;
trees, not rows, pass through it.

Objective: logistic loss with g = w (p - y), h = w p (1 - p); gain = GL²/(HL+λ) + GR²/(HR+λ) - G²/(H+λ); a child
needs a Hessian sum of ``min_child_weight``; a leaf is -η G / (H + λ). Missing values go to the side that gains more.
Rows are drawn per round by a hash of the row key, features per tree by a seeded draw, so a retried task repeats both.

Margins are not stored per round: a task re-evaluates the trees since the last written margins (at most
``STATE_EVERY``), and the state table is then rewritten in the shared folder, so a lost executor costs a retry and
lineage stays short. The number of passes is that of the longest configuration (at most rounds × depth), whatever the
number of configurations. Memory per task: nodes × features × bins × 24 bytes per configuration, set by the
configurations alone, or the rows of one small node.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, StructField, StructType

from hourglass.session import checkpoint_dir, reuse

MAX_BINS = 64
MISSING = 255
STATE_EVERY = 25
#: Rows of the state table that one task reads, at least.
STATE_ROWS = 2000
#: A node whose rows (a byte per feature, two doubles) take no more is finished by one task.
NODE_BYTES = 4 << 20
L2 = 1.0
LEAST_GAIN = 1e-6
SUBSAMPLE = 0.8
COLSAMPLE = 0.8


@dataclass(frozen=True)
class Config:
    """One member: its hyper-parameters and the subset of training rows (a bit of ``member``) it learns from."""

    n_estimators: int
    learning_rate: float
    max_depth: int
    min_child_weight: float = 1.0
    scale_pos_weight: float = 1.0
    subset: int = 0
    subsample: float = SUBSAMPLE
    colsample: float = COLSAMPLE
    seed: int = 42


class Tree:
    """A tree over binned features; the children of node i are 2 i and 2 i + 1, the root is 1."""

    def __init__(self, depth: int):
        n = 2 << depth
        self.feature = np.full(n, -1, np.int32)
        self.cut = np.zeros(n, np.int16)
        self.missing_left = np.zeros(n, bool)
        self.weight = np.zeros(n)
        self.depth = depth

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that every row of ``bins`` (rows × features) has reached."""
        return Forest([self]).nodes(bins)[:, 0]


class Forest:
    """Trees of one depth side by side, so that a level of all of them is one numpy step."""

    #: rows × trees of a step
    STEP = 1 << 18

    def __init__(self, trees: list[Tree]):
        self.depth, self.n = (trees[0].depth if trees else 0), len(trees)
        if trees:
            self.feature, self.cut, self.missing_left, self.weight = (
                np.stack([getattr(t, c) for t in trees]) for c in ("feature", "cut", "missing_left", "weight"))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node (rows × trees) that every row has reached in every tree."""
        at = np.ones((len(bins), self.n), np.int64)
        rows, trees = np.arange(len(bins))[:, None], np.arange(self.n)[None, :]
        for _ in range(self.depth):
            f = self.feature[trees, at]
            if not (f >= 0).any():
                break
            b = bins[rows, np.maximum(f, 0)]
            left = np.where(b == MISSING, self.missing_left[trees, at], b <= self.cut[trees, at])
            at = np.where(f >= 0, 2 * at + ~left, at)
        return at

    def add_margins(self, bins: np.ndarray, margin: np.ndarray) -> None:
        """Add every tree's weight, in order, to the margins of the rows of ``bins``."""
        if not self.n:
            return
        step = max(1, self.STEP // self.n)
        for i in range(0, len(bins), step):
            weights = self.weight[np.arange(self.n)[None, :], self.nodes(bins[i:i + step])]
            for t in range(self.n):
                margin[i:i + step] += weights[:, t]


# ------------------------------------------------------------------ binning
def bin_edges(train: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cut points per feature from quantiles of the non-missing training values (one aggregation); a value
    x falls into bin i where edge[i-1] < x <= edge[i]."""
    probs = [i / max_bins for i in range(1, max_bins)]

    def present(c):
        x = F.col(c).cast("double")
        return F.when(F.isnan(x), None).otherwise(x)

    row = train.agg(*[F.percentile_approx(present(c), probs, 10000).alias(f"f{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.asarray(row[f"f{i}"] or [], dtype=float)) for i in range(len(features))]


def binned(df: DataFrame, features: list[str], edges: list[np.ndarray], keep: list[str]) -> DataFrame:
    """``keep`` and ``bins``: one byte per feature (its bin, ``MISSING`` for null and NaN)."""
    chosen = df.select(*keep, *[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)])
    target = StructType([*df.select(*keep).schema.fields, StructField("bins", BinaryType())])
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(target)
        for b in batches:
            codes = np.full((b.num_rows, len(edges)), MISSING, np.uint8)
            for i, e in enumerate(edges):
                x = b.column(n_keep + i).to_numpy(zero_copy_only=False).astype(float)
                there = ~np.isnan(x)
                codes[there, i] = np.searchsorted(e, x[there], side="left")
            kept = [b.column(i).cast(out[i].type) for i in range(n_keep)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([c.tobytes() for c in codes], pa.binary())], schema=out)

    return chosen.mapInArrow(run, target)


# ------------------------------------------------------------------ one pass
@dataclass
class Growing:
    """What a configuration is doing: its round, the open nodes of the tree it grows, the features it may use."""

    config: Config
    n_features: int
    done: list[Tree] = field(default_factory=list)
    pending: list[Tree] = field(default_factory=list)
    tree: Tree | None = None
    open: list[int] = field(default_factory=list)
    used: np.ndarray | None = None
    #: training rows of the subset, and of every open node (at most)
    n_rows: int = 0
    rows: dict[int, float] = field(default_factory=dict)

    @property
    def round(self) -> int:
        return len(self.done) + len(self.pending)

    @property
    def active(self) -> bool:
        return self.round < self.config.n_estimators

    def start(self) -> None:
        c = self.config
        self.tree, self.open, self.rows = Tree(c.max_depth), [1], {1: self.n_rows}
        rng = np.random.default_rng([c.seed, self.round])
        n = max(1, int(round(c.colsample * self.n_features)))
        self.used = np.sort(rng.permutation(self.n_features)[:n])

    def small(self) -> list[int]:
        """The open nodes that one task finishes."""
        most = NODE_BYTES // (len(self.used) + 16)
        return [n for n in self.open if self.rows[n] <= most]


class Work:
    """What the tasks of a pass need of a configuration: ``nodes`` of the tree it grows, the trees not in the margins."""

    def __init__(self, index: int, w: Growing, nodes: list[int]):
        self.index, self.config, self.round, self.used, self.tree = index, w.config, w.round, w.used, w.tree
        self.nodes, self.pending = nodes, Forest(w.pending)

    def rows(self, label, member, key, codes, held):
        """``(rows, place in nodes, g, h)`` of the drawn rows of a batch that are in ``nodes``."""
        c = self.config
        node = self.tree.nodes(codes)
        place = np.full(len(self.tree.feature), -1, np.int64)
        place[self.nodes] = np.arange(len(self.nodes))
        slot = place[node]
        take = np.flatnonzero((slot >= 0) & ((member >> c.subset) & 1 == 1) & drawn(key, c, self.round))
        margin = held[take, self.index]
        self.pending.add_margins(codes[take], margin)
        p = 1 / (1 + np.exp(-margin))
        weight = np.where(label[take] == 1, c.scale_pos_weight, 1.0)
        return take, slot[take], weight * (p - label[take]), weight * p * (1 - p)


def drawn(keys: np.ndarray, config: Config, round_: int) -> np.ndarray:
    """The rows that a round learns from: a share ``subsample`` by a hash of key, seed and round."""
    if config.subsample >= 1:
        return np.ones(len(keys), bool)
    h = keys.astype(np.uint64) ^ np.uint64((config.seed * 0x9E3779B1 + 1) * (round_ + 1) % (1 << 64))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h >> np.uint64(11)).astype(float) / float(1 << 53) < config.subsample


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    label, member, key, bins, margins = batch.columns
    n = batch.num_rows
    codes = np.frombuffer(b"".join(bins.to_pylist()), np.uint8).reshape(n, -1)
    held = margins.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    return label.to_numpy(zero_copy_only=False), member.to_numpy(zero_copy_only=False), key.to_numpy(zero_copy_only=False), codes, held


def _cells(slot: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray, n_nodes: int) -> np.ndarray:
    """Sums of g, h and rows per (place of the node, feature, bin)."""
    n_used = codes.shape[1]
    at = ((slot[:, None] * n_used + np.arange(n_used)) * 256 + codes).ravel()
    size = n_nodes * n_used * 256
    return np.stack([np.bincount(at, np.repeat(g, n_used), size), np.bincount(at, np.repeat(h, n_used), size),
                     np.bincount(at, minlength=size).astype(float)])


def _sum_columns(sums: np.ndarray, index: int, nodes: list[int], used: np.ndarray) -> dict[str, np.ndarray]:
    """The cells with rows as columns of ``_SUMS``."""
    at = np.flatnonzero(sums[1])
    slot, feature = np.divmod(at // 256, len(used))
    return {"config": np.full(len(at), index, np.int32), "node": np.asarray(nodes, np.int32)[slot],
            "feature": used[feature].astype(np.int32), "bin": (at % 256).astype(np.int32),
            "g": sums[0][at], "h": sums[1][at], "n": sums[2][at]}


def _partial_sums(work: list[Work]):
    """Map side: sums of g, h and rows per (config, node, feature, bin) over a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            label, member, key, codes, held = _columns(batch)
            for i, w in enumerate(work):
                take, slot, grad, hess = w.rows(label, member, key, codes, held)
                if not len(take):
                    continue
                cells = _cells(slot, codes[take][:, w.used], grad, hess, len(w.nodes))
                sums[i] = sums[i] + cells if i in sums else cells
        for i, found in sums.items():
            yield pa.RecordBatch.from_pydict(_sum_columns(found, work[i].index, work[i].nodes, work[i].used))

    return run


def _node_rows(work: list[Work]):
    """Map side: the rows of every (config, node) of a batch, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            label, member, key, codes, held = _columns(batch)
            for w in work:
                take, slot, grad, hess = w.rows(label, member, key, codes, held)
                for k in np.unique(slot):
                    at = slot == k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w.index], pa.int32()), pa.array([w.nodes[k]], pa.int32()),
                         *[pa.array([x[at].tobytes()], pa.binary()) for x in (codes[take][:, w.used], grad, hess)]], names=_ROWS.names)

    return run


def _finish(work: list[Work]):
    """Reduce side: the splits of all levels from a small node on; the rows of a (config, node) arrive together."""
    of = {w.index: w for w in work}

    def subtree(index: int, node: int, parts: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
        w = of[index]
        c = w.config
        least = np.zeros(index + 1)
        least[index] = c.min_child_weight
        codes = np.frombuffer(b"".join(p[0] for p in parts), np.uint8).reshape(-1, len(w.used))
        grad, hess = (np.frombuffer(b"".join(p[i] for p in parts), float) for i in (1, 2))
        slot, nodes = np.zeros(len(codes), np.int64), [node]
        column = np.zeros(int(w.used.max()) + 1, np.int64)
        column[w.used] = np.arange(len(w.used))
        while nodes:
            found = best_splits(_sum_columns(_cells(slot, codes, grad, hess, len(nodes)), index, nodes, w.used), least)
            yield _splits_batch(found)
            after, place = [], np.full((len(nodes), 2), -1, np.int64)
            feature, cut, missing_left = np.zeros(len(nodes), np.int64), np.full(len(nodes), -1), np.zeros(len(nodes), bool)
            where = {n: k for k, n in enumerate(nodes)}
            for r in zip(*[x.tolist() for x in found], strict=True):
                s = dict(zip(_SPLITS.names, r, strict=True))
                if s["gain"] <= 0:
                    continue
                k = where[s["node"]]
                feature[k], cut[k], missing_left[k] = column[s["feature"]], s["cut"], s["missing_left"]
                for side, h in ((0, s["left_h"]), (1, s["h"] - s["left_h"])):
                    child = 2 * s["node"] + side
                    if goes_on(c, child, h):
                        place[k, side] = len(after)
                        after.append(child)
            b = codes[np.arange(len(codes)), feature[slot]]
            left = np.where(b == MISSING, missing_left[slot], b <= cut[slot])
            slot = place[slot, (~left).astype(np.int64)]
            stays = slot >= 0
            codes, grad, hess, slot, nodes = codes[stays], grad[stays], hess[stays], slot[stays], after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for b in batches:
            for index, node, *part in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if at != (index, node):
                    if parts:
                        yield from subtree(*at, parts)
                    at, parts = (index, node), []
                parts.append(part)
        if parts:
            yield from subtree(*at, parts)

    return run


_SUMS = StructType([StructField(c, IntegerType()) for c in ("config", "node", "feature", "bin")]
                   + [StructField(c, DoubleType()) for c in ("g", "h", "n")])
_ROWS = StructType([StructField(c, IntegerType()) for c in ("config", "node")]
                   + [StructField(c, BinaryType()) for c in ("codes", "g", "h")])
_SPLITS = StructType([StructField("config", IntegerType()), StructField("node", IntegerType()), StructField("gain", DoubleType()),
                      StructField("feature", IntegerType()), StructField("cut", IntegerType()), StructField("missing_left", BooleanType()),
                      *[StructField(c, DoubleType()) for c in ("g", "h", "left_g", "left_h", "n", "left_n")]])
#: Sums of a pass that one task of the picking side takes, about 32 bytes each.
SUMS_PER_TASK = 2_000_000


def best_splits(table: dict[str, np.ndarray], least: np.ndarray, l2: float = L2) -> list[np.ndarray]:
    """The columns of ``_SPLITS``: the best split of every (config, node) of complete (config, node, feature) sums;
    gain 0 where none is allowed.

    Ties go to the smaller feature, then the smaller cut, then missing values to the left."""
    order = np.lexsort((table["bin"], table["feature"], table["node"], table["config"]))
    t = {k: v[order] for k, v in table.items()}
    same = (np.diff(t["config"]) == 0) & (np.diff(t["node"]) == 0) & (np.diff(t["feature"]) == 0)
    first = np.concatenate(([True], ~same))
    group = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    n = np.bincount(group)
    absent = t["bin"] == MISSING
    total, lost, below = [], [], []
    for c in ("g", "h", "n"):
        run = np.cumsum(t[c])
        below.append(run - np.repeat(run[starts] - t[c][starts], n))
        total.append(np.add.reduceat(t[c], starts)[group])
        lost.append(np.bincount(group, np.where(absent, t[c], 0.0))[group])
    need = least[t["config"]]
    tried = []
    for missing_left in (True, False):
        lg, lh, ln = (b + m * missing_left for b, m in zip(below, lost, strict=True))
        rg, rh = total[0] - lg, total[1] - lh
        gain = lg * lg / (lh + l2) + rg * rg / (rh + l2) - total[0] * total[0] / (total[1] + l2)
        allowed = ~absent & (lh >= need) & (rh >= need) & (lh > 0) & (rh > 1e-12) & (gain > LEAST_GAIN)
        tried.append((np.where(allowed, np.round(gain, 9), 0.0), lg, lh, ln))
    gain, lg, lh, ln = (np.concatenate(x) for x in zip(*tried, strict=True))
    both = {k: np.concatenate((v, v)) for k, v in t.items()}
    right = np.repeat([False, True], len(absent))
    rank = np.lexsort((right, both["bin"], both["feature"], -gain, both["node"], both["config"]))
    ahead = np.concatenate(([True], (np.diff(both["config"][rank]) != 0) | (np.diff(both["node"][rank]) != 0)))
    best = rank[ahead]
    g, h, n = (np.concatenate((x, x)) for x in total)
    return [both["config"][best], both["node"][best], gain[best], both["feature"][best], both["bin"][best], ~right[best],
            g[best], h[best], lg[best], lh[best], n[best], ln[best]]


def _splits_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.float64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(found, types, strict=True)], names=_SPLITS.names)


def _pick(least: np.ndarray):
    """Reduce side: best splits of the (config, node, feature) groups that a partition holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        whole = pa.Table.from_batches(parts)
        yield _splits_batch(best_splits({c: whole[c].to_numpy() for c in whole.column_names}, least))

    return run


def pass_splits(state: DataFrame, growing: list[Growing]) -> list:
    """One pass over all active configurations: the best split of every open node with many rows, one row per node and
    task, and the splits of the whole subtree of every other open node."""
    small = {i: w.small() for i, w in enumerate(growing) if w.active}
    narrow = [Work(i, growing[i], nodes) for i, nodes in small.items() if nodes]
    wide = [Work(i, growing[i], nodes) for i in small if (nodes := [n for n in growing[i].open if n not in small[i]])]
    found = None
    if wide:
        least = np.array([w.config.min_child_weight for w in growing])
        tasks = 1 + sum(len(w.nodes) * len(w.used) * MAX_BINS for w in wide) // SUMS_PER_TASK
        sums = state.mapInArrow(_partial_sums(wide), _SUMS)
        summed = (sums.repartition(tasks, "config", "node", "feature").groupBy("config", "node", "feature", "bin")
                  .agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]))
        found = summed.mapInArrow(_pick(least), _SPLITS)
    if narrow:
        held = sum(growing[w.index].rows[n] * (len(w.used) + 16) for w in narrow for n in w.nodes)
        groups = sum(len(w.nodes) for w in narrow)
        tasks = max(1 + int(held) // (8 * NODE_BYTES), min(groups, state.sparkSession.sparkContext.defaultParallelism))
        task = F.pmod(F.col("config") + F.col("node") * F.lit(len(growing)), F.lit(tasks)).cast("int")
        rows = state.mapInArrow(_node_rows(narrow), _ROWS).repartitionById(tasks, task)
        finished = rows.sortWithinPartitions("config", "node").mapInArrow(_finish(narrow), _SPLITS)
        found = finished if found is None else found.unionByName(finished)
    return found.collect()


def goes_on(c: Config, child: int, h: float) -> bool:
    """A child that is too light for two children, or deep enough, stays a leaf."""
    return child < 1 << c.max_depth and h >= 2 * c.min_child_weight


def grow(w: Growing, splits: dict[int, tuple]) -> None:
    """Apply a pass's splits to a configuration; a finished tree joins ``pending``."""
    c, after, rows = w.config, [], {}
    whole = set(w.small())
    todo = list(w.open)
    for node in todo:
        s = splits.get(node)
        if s is None or s.gain <= 0:
            if s is not None:
                w.tree.weight[node] = -c.learning_rate * s.g / (s.h + L2)
            continue
        w.tree.feature[node], w.tree.cut[node], w.tree.missing_left[node] = s.feature, s.cut, s.missing_left
        for child, g, h, n in ((2 * node, s.left_g, s.left_h, s.left_n),
                               (2 * node + 1, s.g - s.left_g, s.h - s.left_h, s.n - s.left_n)):
            w.tree.weight[child] = -c.learning_rate * g / (h + L2)
            if goes_on(c, child, h):
                if node in whole:
                    whole.add(child)
                    todo.append(child)
                else:
                    after.append(child)
                    rows[child] = n
    w.open, w.rows = after, rows
    if not after:
        w.pending.append(w.tree)
        w.tree = None


# ------------------------------------------------------------------ fitting and scoring
def _written(df: DataFrame, name: str, tasks: int) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, in ``tasks`` files of even size, and its path. Its blocks are kept for the
    passes (a lost one is read again)."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/hourglass-boosting/{name}-{uuid.uuid4().hex}"
    df.repartition(tasks).write.parquet(path)
    return reuse(df.sparkSession.read.schema(df.schema).parquet(path)), path


def _drop(table: DataFrame, path: str) -> None:
    table.unpersist()
    spark = table.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _advanced(state: DataFrame, growing: list[Growing]) -> DataFrame:
    """The state with the pending trees added to its margins."""
    trees = [Forest(w.pending) for w in growing]
    target = state.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            *_, codes, held = _columns(b)
            held = held.copy()
            for i, forest in enumerate(trees):
                forest.add_margins(codes, held[:, i])
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(list(held), pa.list_(pa.float64()))], names=b.schema.names)

    return state.mapInArrow(run, target)


@dataclass
class Boosters:
    """Fitted members: the cut points of the features and the trees of every configuration."""

    features: list[str]
    edges: list[np.ndarray]
    trees: list[list[Tree]]
    passes: int = 0

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, ``config`` and ``y_prob`` of every row and configuration; the trees travel with the tasks."""
        rows = binned(df, self.features, self.edges, keep)
        target = StructType([*rows.schema.fields[:-1], StructField("config", IntegerType()), StructField("y_prob", DoubleType())])
        shared = df.sparkSession.sparkContext.broadcast([Forest(ts) for ts in self.trees])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                codes = np.frombuffer(b"".join(b.column(b.num_columns - 1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                for i, forest in enumerate(shared.value):
                    margin = np.zeros(b.num_rows)
                    forest.add_margins(codes, margin)
                    yield pa.RecordBatch.from_arrays(
                        [*b.columns[:-1], pa.array(np.full(b.num_rows, i, np.int32)), pa.array(1 / (1 + np.exp(-margin)))],
                        names=[*b.schema.names[:-1], "config", "y_prob"])

        return rows.mapInArrow(run, target)


def fit(train: DataFrame, features: list[str], configs: list[Config], label: str = "label", key_col: str = "id",
        member_col: str | None = None, max_bins: int = MAX_BINS) -> Boosters:
    """Fit every configuration on ``train`` (its rows with the configuration's bit in ``member_col``; all without one).

    Null labels are left out. No rows, or one class, give trees without splits."""
    rows = train.where(F.col(label).isNotNull())
    edges = bin_edges(rows, features, max_bins)
    keyed = rows.select(F.col(label).cast("double").alias("label"),
                        (F.col(member_col).cast("long") if member_col else F.lit(-1).cast("long")).alias("member"),
                        F.xxhash64(key_col).alias("key"), *features)
    subsets = sorted({c.subset for c in configs})
    held = keyed.agg(F.count(F.lit(1)).alias("n"), *[
        F.count(F.when(F.expr(f"shiftright(member, {s}) & 1") == 1, 1)).alias(f"s{s}") for s in subsets]).first()
    # the passes cost the same work per row and configuration, whatever the bytes
    tasks = max(1, min(held["n"] // STATE_ROWS, keyed.sparkSession.sparkContext.defaultParallelism), held["n"] * len(configs) // 8_000_000)
    start = F.array_repeat(F.lit(0.0), len(configs))
    state, path = _written(binned(keyed, features, edges, ["label", "member", "key"]).select("*", start.alias("margins")), "state", tasks)
    growing, passes = [Growing(c, len(features), n_rows=held[f"s{c.subset}"]) for c in configs], 0
    while any(w.active for w in growing):
        for w in growing:
            if w.active and w.tree is None:
                w.start()
        found: dict[int, dict] = {}
        for r in pass_splits(state, growing):
            best = found.setdefault(r.config, {})
            mine = (r.gain, -r.feature, -r.cut, r.missing_left)
            if r.node not in best or mine > best[r.node][0]:
                best[r.node] = (mine, r)
        passes += 1
        for i, w in enumerate(growing):
            if w.active:
                grow(w, {node: r for node, (_, r) in found.get(i, {}).items()})
        if max(len(w.pending) for w in growing) >= STATE_EVERY:
            old = state, path
            state, path = _written(_advanced(state, growing), "state", tasks)
            _drop(*old)
            for w in growing:
                w.done, w.pending = w.done + w.pending, []
    _drop(state, path)
    return Boosters(list(features), edges, [w.done + w.pending for w in growing], passes)
