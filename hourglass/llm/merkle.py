"""Merkle dataset manifest in a van Emde Boas layout.

Every row is a leaf; the leaves of a group (a language) ascend by id, and runs of eight nodes are hashed into one
until one remains, the group's root. The group roots, ordered by group, are the leaves of a tree of the same kind.

Storage. A tree is cut into aligned subtrees of ``LEVELS`` levels above their leaves, one block each. Within a block
nodes lie in van Emde Boas order: the tree is split at half its height, the upper part is stored first and then
each lower subtree contiguously, every one of them split the same way again. ``address`` gives a node's place by
arithmetic alone; building a block and fetching siblings both go through it, so a walk towards the root stays within
few short stretches whatever the size of a cache line or page. The roots of a round's blocks are the leaves of the
next round's, until a tree has one block.

Scale. Rows are put in order by a range partitioning of (group, id, leaf), in which even equal rows are spread; a
row's position is its place in its partition plus an offset per partition and group. A block holds at most
8^LEVELS rows, whatever the size of its group, and is one small task group. Rounds shrink by that factor; proofs go
down the same way, one row per block, so only digests of a leaf's own block meet it.

Defined results: null values are hashed as ``-``; null ids come first within their group and the null group first;
rows that share an id are ordered by leaf, and equal rows are leaves of their own; a null id is never tampered with;
texts are hashed whole; an empty table gives an empty table and no root; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.storage import written

FAN = 8
LEVELS = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 32


# ------------------------------------------------------------------ addresses
def tree_size(depth: int) -> int:
    """Nodes of a full tree with ``depth`` levels of nodes."""
    return (FAN ** depth - 1) // (FAN - 1)


def address(depth: int, level: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` of ``level`` (the root is level 0) in a tree of ``depth`` levels of nodes."""
    if depth == 1:
        return np.zeros_like(index)
    above = depth // 2
    if level < above:
        return address(above, level, index)
    width = FAN ** (level - above)
    subtree, inner = index // width, index % width
    return tree_size(above) + subtree * tree_size(depth - above) + address(depth - above, level - above, inner)


@functools.lru_cache(maxsize=64)
def addresses(depth: int, level: int) -> np.ndarray:
    return address(depth, level, np.arange(FAN ** level, dtype=np.int64))


# ------------------------------------------------------------------ one block
def hashed(digests: list[bytes]) -> bytes:
    """Hash of the digests' hex texts, concatenated."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def block_depth(total: int, levels: int = LEVELS) -> int:
    """Levels of nodes of a block whose tree has ``total`` leaves in this round."""
    depth = 1
    while depth <= levels and FAN ** (depth - 1) < total:
        depth += 1
    return depth


def widths(n: int, depth: int) -> list[int]:
    """Nodes present on each level (root first) of a block with ``n`` leaves."""
    out = [n]
    for _ in range(depth - 1):
        out.append(-(-out[-1] // FAN))
    return out[::-1]


def build_block(leaves: list[bytes], depth: int) -> bytes:
    """All nodes of a block at their addresses; places without a node are zero."""
    store = bytearray(_DIGEST * tree_size(depth))
    row, places = leaves, addresses(depth, depth - 1)
    for level in range(depth - 1, -1, -1):
        places = addresses(depth, level)
        for i, d in enumerate(row):
            at = int(places[i]) * _DIGEST
            store[at:at + _DIGEST] = d
        row = [hashed(row[i:i + FAN]) for i in range(0, len(row), FAN)]
    return bytes(store)


class Block:
    """A stored block: nodes and runs of siblings by address."""

    def __init__(self, store: bytes, n: int, depth: int):
        self.store, self.depth, self.present = store, depth, widths(n, depth)
        self.runs: dict[tuple[int, int], list[bytes]] = {}

    def node(self, level: int, index: int) -> bytes:
        at = int(addresses(self.depth, level)[index]) * _DIGEST
        return self.store[at:at + _DIGEST]

    def run(self, level: int, run: int) -> list[bytes]:
        if (level, run) not in self.runs:
            first = run * FAN
            self.runs[level, run] = [self.node(level, i) for i in range(first, min(first + FAN, self.present[level]))]
        return self.runs[level, run]

    def path(self, leaf: int) -> list[tuple[int, list[bytes]]]:
        """Leaf to root: the place in the run and the run's other nodes."""
        steps = []
        for level in range(self.depth - 1, 0, -1):
            run = self.run(level, leaf // FAN)
            at = leaf % FAN
            steps.append((at, run[:at] + run[at + 1:]))
            leaf //= FAN
        return steps


def pack(steps: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes((at, len(others))) + b"".join(others) for at, others in steps)


def unpack(path: bytes) -> list[tuple[int, list[bytes]]]:
    steps, i = [], 0
    while i < len(path):
        at, n = path[i], path[i + 1]
        i += 2
        steps.append((at, [path[j:j + _DIGEST] for j in range(i, i + n * _DIGEST, _DIGEST)]))
        i += n * _DIGEST
    return steps


def fold(leaf: bytes, steps: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for at, others in steps:
        leaf = hashed([*others[:at], leaf, *others[at:]])
    return leaf


# ------------------------------------------------------------------ leaves and their order
def encoded(value: Column) -> Column:
    """A value as its byte count, ``:`` and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(columns: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in columns.values()]).cast("binary"), 256))


def leaf_table(docs: DataFrame, columns=COLUMNS, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``tree``, ``doc_id``, ``leaf``, and ``tampered``: the leaf of the row after tampering, null where there is none."""
    values = {c: F.col(c) for c in columns}
    lowered = F.translate(F.col(text_col), UPPER, UPPER.lower())
    touched = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 0
    return docs.select(F.col(group_col).cast("string").alias("tree"), F.col(id_col).alias("doc_id"), digest(values).alias("leaf"),
                       F.when(touched, digest(values | {text_col: lowered})).alias("tampered"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (a written table with ``tree``) with ``position`` within the tree by ``order`` and the tree's ``total``."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    # rows that are equal in all keys are spread too: any order of theirs is the same order
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys, F.col("_tie"))
    ordered = spread.sortWithinPartitions(*keys, "_tie").drop("_tie").withColumn("_place", F.monotonically_increasing_id())
    ordered = written(ordered, "ordered").withColumn("_slice", F.shiftright("_place", 33))
    runs = ordered.groupBy("tree", "_slice").agg(F.count("*").alias("n"), F.min("_place").alias("first"))
    before = Window.partitionBy("tree").orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per (partition, tree)
    runs = written(runs.select(F.col("tree").alias("_tree"), F.col("_slice").alias("_run"),
                               (F.sum("n").over(before) - F.col("n") - F.col("first")).alias("_shift"),
                               F.sum("n").over(Window.partitionBy("tree")).alias("total")), "runs")
    met = ordered.join(runs, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_slice") == F.col("_run")))
    return met.select(*rows.columns, (F.col("_place") + F.col("_shift")).alias("position"), "total")


# ------------------------------------------------------------------ forests
def _key(size: int) -> Column:
    return F.floor(F.col("position") / size).cast("long")


def blocks_of(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The blocks over ``nodes`` (tree, total, position, leaf): (tree, total, block, n, store, root)."""
    size = FAN ** levels

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        total = int(rows.total.iloc[0])
        depth = block_depth(total, levels)
        store = build_block([bytes(x) for x in rows.leaf], depth)
        top = Block(store, len(rows), depth).node(0, 0)
        return pd.DataFrame([(rows.tree.iloc[0], total, int(rows.block.iloc[0]), len(rows), store, top)],
                            columns=["tree", "total", "block", "n", "store", "root"])

    keyed = nodes.select("tree", "total", "position", "leaf", _key(size).alias("block"))
    return keyed.groupBy("tree", "block").applyInPandas(
        build, "tree string, total long, block long, n int, store binary, root binary")


def forest(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The written blocks of every round, leaves' blocks first. A tree with one block ends in its round."""
    size = FAN ** levels
    rounds = [written(blocks_of(nodes, levels), "blocks")]
    while not (more := rounds[-1].filter(F.col("total") > size)).isEmpty():
        up = more.select("tree", F.ceil(F.col("total") / size).cast("long").alias("total"), F.col("block").alias("position"),
                         F.col("root").alias("leaf"))
        rounds.append(written(blocks_of(up, levels), "blocks"))
    return rounds


def tree_roots(rounds: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """``tree``, ``root`` of every tree of a forest."""
    ends = [r.filter(F.col("total") <= FAN ** levels).select("tree", "root") for r in rounds]
    return functools.reduce(DataFrame.unionByName, ends)


def _same_block(a: str, b: str) -> Column:
    return F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.block") == F.col(f"{b}.block"))


def descend(rounds: list[DataFrame], paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``tree``, ``block``, ``path`` (packed, block root to the very top) of the blocks of the first round, from
    ``paths`` (tree, path) of the tree roots."""

    def expand(batches):
        for rows in batches:
            out = []
            for r in rows.itertuples():
                block = Block(bytes(r.store), int(r.n), block_depth(int(r.total), levels))
                first = int(r.block) * FAN ** levels
                out += [(r.tree, first + i, pack(block.path(i)) + bytes(r.path)) for i in range(int(r.n))]
            yield pd.DataFrame(out, columns=["tree", "block", "path"])

    below = None
    for blocks in reversed(rounds):
        ends = blocks.alias("b").filter(F.col("total") <= FAN ** levels).join(
            paths.alias("p"), F.col("b.tree").eqNullSafe(F.col("p.tree"))).select("b.tree", "b.block", "p.path")
        here = ends if below is None else ends.unionByName(below)
        if blocks is rounds[0]:
            return here
        met = blocks.alias("b").join(here.alias("h"), _same_block("b", "h")).select("b.*", "h.path")
        below = written(met.select("tree", "block", "total", "n", "store", "path").mapInPandas(
            expand, "tree string, block long, path binary"), "paths")


# ------------------------------------------------------------------ the manifest
@dataclass
class Manifest:
    """``leaves`` (tree, doc_id, leaf, tampered, position, total), the blocks of the groups' trees and of the tree over
    the group roots, ``subroots`` (tree, root, position, total) and the dataset's ``root`` (None without rows)."""

    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: bytes | None
    levels: int = LEVELS


def build(leaves: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest over :func:`leaf_table`; every table of it is written to the shared folder."""
    ordered = written(placed(written(leaves, "leaves"), ["doc_id", "leaf"]), "leaves")
    rounds = forest(ordered, levels)
    # the groups are the leaves of one more tree
    groups = tree_roots(rounds, levels).select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("leaf"))
    subroots = written(placed(written(groups, "roots"), ["group"]), "roots")
    top = forest(subroots, levels)
    last = tree_roots(top, levels).first()
    return Manifest(ordered, rounds, subroots, top, bytes(last.root) if last else None, levels)


def proofs(m: Manifest) -> DataFrame:
    """Every leaf with its proof: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof`` (packed siblings, leaf to root),
    ``folded_root`` (from the tampered leaf where there is one) and ``verified``; digests are binary."""
    size = FAN ** m.levels
    spark = m.leaves.sparkSession
    start = spark.createDataFrame([("", b"")], "tree string, path binary")
    up = descend(m.top, start, m.levels)
    levels, root = m.levels, m.root

    def to_groups(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            r = right.iloc[0]
            block = Block(bytes(r.store), int(r.n), block_depth(int(r.total), levels))
            first = int(r.block) * size
            out = [(g, pack(block.path(int(p) - first)) + bytes(r.path), bytes(x))
                   for g, p, x in zip(left.group, left.position, left.leaf, strict=True)]
        return pd.DataFrame(out, columns=["tree", "path", "subroot"])

    top = m.top[0].alias("b").join(up.alias("h"), _same_block("b", "h")).select("b.*", "h.path")
    rows = m.subroots.select("tree", "group", "position", "leaf", _key(size).alias("block"))
    paths = written(rows.groupBy("tree", "block").cogroup(top.groupBy("tree", "block")).applyInPandas(
        to_groups, "tree string, path binary, subroot binary"), "paths")

    above = descend(m.rounds, paths.select("tree", "path"), m.levels)
    blocks = m.rounds[0].alias("b").join(above.alias("h"), _same_block("b", "h")).select("b.*", "h.path")
    blocks = blocks.alias("b").join(paths.alias("p"), F.col("b.tree").eqNullSafe(F.col("p.tree"))).select("b.*", "p.subroot")
    id_type = m.leaves.schema["doc_id"].dataType.simpleString()

    def prove(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            r = right.iloc[0]
            block = Block(bytes(r.store), int(r.n), block_depth(int(r.total), levels))
            rest, packed_rest, first = unpack(bytes(r.path)), bytes(r.path), int(r.block) * size
            for position, leaf, tampered in zip(left.position, left.leaf, left.tampered, strict=True):
                steps = block.path(int(position) - first)
                folded = fold(bytes(leaf if tampered is None else tampered), steps + rest)
                out.append((bytes(leaf), r.subroot, root, pack(steps) + packed_rest, folded, folded == root))
        made = pd.DataFrame(out, columns=["leaf", "subroot", "root", "proof", "folded_root", "verified"])
        made.insert(0, "doc_id", left.doc_id.to_numpy() if len(out) else [])
        return made

    # ids travel as text, so that null ids stay null whatever their type
    rows = m.leaves.select("tree", F.col("doc_id").cast("string").alias("doc_id"), "position", "leaf", "tampered",
                           _key(size).alias("block"))
    done = rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(
        prove, "doc_id string, leaf binary, subroot binary, root binary, proof binary, folded_root binary, verified boolean")
    return done.withColumn("doc_id", F.col("doc_id").cast(id_type))


def proof_hash(proof: bytes) -> str:
    """Hash of the siblings' hex texts, level by level, left to right."""
    return hashed([d for _, others in unpack(proof) for d in others]).hex()


def with_proof_hash(proved: DataFrame) -> DataFrame:
    """``proof_sha256`` of every proof."""

    @F.pandas_udf("string")
    def of(proof: pd.Series) -> pd.Series:
        return proof.map(lambda p: proof_hash(bytes(p)))

    return proved.withColumn("proof_sha256", of("proof"))
