"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Texts of equal shingle sets are one class, represented by its smallest (id, row key); the row key stands for
   the class in all that follows, so ids may repeat or be missing.
2. Every class has a signature of ``TREES`` x ``DEPTH`` minima. In each tree the classes are sorted by their
   part of the signature; a class's candidates are the neighbours that share its longest prefixes, at least
   ``MIN_DEPTH`` values. The depth adapts to the region: where only a few classes share a short prefix, all of
   them are neighbours; where many do, only those with the deepest common prefixes still are. Neighbours
   whose sketches (one bit of every minimum) are far apart are no candidates.
3. Candidates' connected components are clusters, and a pair that shares a prefix in some tree is in one
   cluster. Inside a cluster every pair is confirmed on the full sets, in blocks of bounded size: only links of
   a spanning forest leave a task, never the pairs. A cluster above ``BLOCK`` classes is dealt to blocks, and
   every pair of blocks is a task of its own.
4. The links' connected components are the result.

At the least similarity (0.85) a pair shares 4 values in none of 16 trees with probability 7e-6; the measured
recall is in the README. The cost of step 3 grows with the square of a cluster's classes of different sets,
spread over the cluster's blocks; exact copies never enter it.

Defined results: null, empty and blank texts have no shingles and link to nothing; a text of fewer words than
a shingle is one shingle; rows without an id are given null as component, and take part in the links only with
``idless``; rows that repeat an id keep the class of their own text; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.graph import components
from hourglass.llm.storage import written
from hourglass.llm.text import WordHashes, enter, keeps, mix, row_key, slices

SHINGLE = 3
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 85
TREES, DEPTH, MIN_DEPTH = 16, 8, 4
#: Sketches of 128 bits that differ in more bits are of sets with an estimated similarity below 0.5.
FAR_BITS = 32
#: Neighbours that a region keeps: the deepest prefixes when there are more.
NEAREST = 24
#: Classes and shingles of a block.
BLOCK, BLOCK_SHINGLES = 192, 200_000

_HASHES = WordHashes(3)
keeps(__name__, _HASHES.clear)
_SEEDS = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULTIPLY = (_SEEDS[::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (_SEEDS[1::2] >> np.uint64(32)).astype(np.uint32)


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = _HASHES.of(words)
    n = max(1, len(h) - width + 1)
    size = min(width, len(h))
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = mix(out) + h[j:j + n] * np.uint64(2 * j + 3)
    return np.unique(mix(out))


def signature(sets: np.ndarray) -> np.ndarray:
    """Minima of TREES * DEPTH hash functions over a set (not empty)."""
    x = (mix(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(out, (_MULTIPLY[:, None] * x[None, at:at + 4096] + _ADD[:, None]).min(axis=1), out=out)
    return out


def sketch(minima: np.ndarray) -> bytes:
    """One hashed bit of every minimum."""
    return np.packbits((minima * np.uint32(0x9E3779B1)) >> np.uint32(31)).tobytes()


def _sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        none = np.empty(0, np.uint64)
        for batch in batches:
            for part in slices(batch):
                n, h1, h2, trees, bits = [], [], [], [], []
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    s = shingles(text, width) if text else none
                    n.append(len(s))
                    if not len(s):
                        for c in (h1, h2, trees, bits):
                            c.append(None)
                        continue
                    # the whole set's hash: sums of two independent scrambles of its members
                    h1.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                    h2.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                    m = signature(s)
                    trees.append(m.astype(">u4").tobytes())
                    bits.append(sketch(m))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                     pa.array(trees, pa.binary()), pa.array(bits, pa.binary())],
                    names=["doc_id", "row_key", "n_shingles", "h1", "h2", "trees", "bits"])

    return docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, row_key long, n_shingles long, h1 long, h2 long, trees binary, bits binary")


def _prefix(a: bytes, b: bytes) -> int:
    """Values of four bytes that two tree keys share from the start."""
    n = 0
    while n < len(a) and a[n:n + 4] == b[n:n + 4]:
        n += 4
    return n // 4


def candidates(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that join neighbours of the sorted orders; ``classes``: node, trees, bits. Neighbours that
    a tree has joined already give no further edge, so a class gives a few edges per tree in any group."""
    size = 4 * DEPTH
    forest = classes.select("node", "bits", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(t.alias("tree"), F.substring("trees", t * size + 1, F.lit(size)).alias("key")))).alias("t"))
    forest = forest.select(F.col("t.tree").alias("tree"), F.col("t.key").alias("key"), "node", "bits")
    # the node as last sort key lets range partitions cut a region of equal keys
    order = forest.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    kind = classes.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        region: list[list] = []  # [values shared with the latest key, key, node, sketch, leader], the deepest last
        at = None
        for batch in batches:
            a, b = [], []
            for tree, key, node, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = int.from_bytes(bits)
                if tree != at or not region:
                    region, at = [], tree
                else:
                    shared = _prefix(region[-1][1], key)
                    if shared < MIN_DEPTH:
                        region = []
                    for x in region:
                        x[0] = min(x[0], shared)
                    region = [x for x in region if x[0] >= MIN_DEPTH]
                near = [x for x in region if (x[3] ^ mine).bit_count() <= FAR_BITS]
                # one edge for each group of neighbours that are not joined yet
                leader = near[0][4] if near else node
                for x in near:
                    if x is near[0] or x[4] != leader:
                        a.append(node)
                        b.append(x[2])
                        joined = x[4]
                        for y in region:
                            if y[4] == joined:
                                y[4] = leader
                region.append([DEPTH, key, node, mine, leader])
                if len(region) > NEAREST:
                    # the shallowest goes; among equals a later one, so that the first leads all of its region
                    least = min(x[0] for x in region[:-1])
                    region.pop(max(i for i, x in enumerate(region[:-1]) if x[0] == least))
            yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field(2).type), pa.array(b, batch.schema.field(2).type)],
                                             names=["a", "b"])

    return order.mapInArrow(run, f"a {kind}, b {kind}")


def linked_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs (i, j), i < j, of sets with 100 * intersection >= percent * union; intersections of all pairs are
    products of the membership matrix, in slices of its columns."""
    sizes = np.array([len(s) for s in sets], np.int64)
    member = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    rank = np.cumsum(counts > 1) - 1
    member, column = member[shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    inter = np.zeros((len(sets), len(sets)), np.float64)
    n_columns = int(column[-1]) + 1 if len(column) else 0
    step = max(256, min(8192, (1 << 21) // len(sets)))
    for at in range(0, n_columns, step):
        lo, hi = np.searchsorted(column, [at, at + step])
        x = np.zeros((len(sets), min(step, n_columns - at)), np.float32)
        x[member[lo:hi], column[lo:hi] - at] = 1
        inter += x @ x.T
    both = np.rint(inter).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    return np.argwhere(np.triu(100 * both >= percent * union, 1))


def spanning_forest(n: int, pairs: np.ndarray) -> Iterator[tuple[int, int]]:
    up = list(range(n))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in pairs.tolist():
        a, b = top(i), top(j)
        if a != b:
            up[max(a, b)] = min(a, b)
            yield i, j


def confirmed(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) inside the blocks; ``texts``: cluster, i, j, node, text, with a block's rows together."""
    kind = texts.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        field = None
        key, nodes, sets = None, [], []

        def links() -> pa.RecordBatch:
            found = list(spanning_forest(len(sets), linked_pairs(sets, percent))) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in found], field),
                                               pa.array([nodes[j] for _, j in found], field)], names=["a", "b"])

        for batch in batches:
            field = batch.schema.field(3).type
            for part in slices(batch):
                cols = [c.to_pylist() for c in part.columns[:4]] + [part.column(4).cast(pa.binary()).to_pylist()]
                for *block, node, text in zip(*cols, strict=True):
                    if block != key:
                        if len(nodes) > 1:
                            yield links()
                        key, nodes, sets = block, [], []
                    nodes.append(node)
                    sets.append(shingles(text, width))
        if len(nodes) > 1:
            yield links()

    return texts.select("cluster", "i", "j", "node", "text").mapInArrow(run, f"a {kind}, b {kind}")


def repeated_keys(rows: DataFrame) -> DataFrame:
    """Row keys that more than one of ``rows`` has."""
    return rows.groupBy("row_key").agg(F.count("*").alias("n_rows")).filter("n_rows > 1").select("row_key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    percent: int = PERCENT, idless: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``row_key``, ``n_shingles``, ``component_id``, ``kept`` (by id) and ``chosen``: whether
    the row key is the component's smallest (id, row key), rows without an id last (see the module's text)."""
    sets = written(_sets(docs, id_col, text_col, width), "sets")
    taken = sets.filter("n_shingles > 0" if idless else "n_shingles > 0 AND doc_id IS NOT NULL")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    classes = written(taken.groupBy("h1", "h2").agg(
        F.min(first).alias("first"), F.first("n_shingles").alias("n"), F.first("trees").alias("trees"),
        F.first("bits").alias("bits")).withColumn("node", F.col("first.row_key")), "classes")
    clusters = components(candidates(classes)).select("node", F.col("component").alias("cluster"))
    sized = classes.select("node", "n").join(clusters, "node")
    blocks = sized.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = clusters.join(blocks, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    keyed = docs.select(row_key(id_col, text_col).alias("node"), F.col(text_col).alias("text"))
    again = written(repeated_keys(taken).withColumnRenamed("row_key", "node"), "repeated")
    if again.isEmpty():
        texts = keyed.join(members, "node")
    else:
        # one text of a row that is listed many times, by partial aggregation
        texts = keyed.join(members.join(again, "node", "left_anti"), "node").unionByName(
            keyed.join(members.join(again, "node"), "node").dropDuplicates(["node"]))
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("block")))
    dealt = texts.withColumn("other", F.explode(other)).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "text")
    dealt = dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    links = components(confirmed(dealt, width, percent))
    tops = links.join(classes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("top"))
    named = classes.select("h1", "h2", "node", "first").join(
        links.join(tops, "component").select("node", "top"), "node", "left").select(
        F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.coalesce("top", "first").alias("top"))
    out = sets.select("doc_id", "row_key", "n_shingles", "h1", "h2").join(
        named, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("top.doc_id", "doc_id"))
    return out.select("doc_id", "row_key", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
                      F.coalesce(F.col("row_key") == F.col("top.row_key"), F.lit(True)).alias("chosen"))
