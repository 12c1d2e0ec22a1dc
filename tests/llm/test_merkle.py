import hashlib
import zlib

import numpy as np
import pytest

from hourglass.llm import merkle as M
from hourglass.llm.queries import op13_merkle_manifest


def sha(text) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(rows):
    """(doc_id, leaf) -> subroot, root, proof hash, folded root, verified; of rows with the columns of documents."""
    def leaf(r, text):
        values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
        return out

    def path(tree, i):
        steps = []
        for nodes in tree[:-1]:
            run = nodes[i // 8 * 8:i // 8 * 8 + 8]
            steps.append((run[:i % 8], run[i % 8 + 1:]))
            i //= 8
        return steps

    groups = {}
    for r in rows:
        low = None if r["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        touched = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, r["text"]), leaf(r, low if touched else r["text"])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels([x[1] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (doc_id, h, f) in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, k)
            for left, right in steps:
                f = sha("".join(left) + f + "".join(right))
            proof = sha("".join("".join(a) + "".join(b) for a, b in steps))
            out.append((doc_id, h, trees[g][-1][0], top[-1][0], proof, f, f == top[-1][0]))
    return sorted(out, key=str)


def computed(docs, levels=M.LEVELS):
    done = M.with_proof_hash(M.proofs(M.build(M.leaf_table(docs), levels)))
    return sorted(((r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.proof_sha256, r.folded_root.hex(), r.verified)
                   for r in done.collect()), key=str)


def test_addresses_are_a_layout_with_contiguous_subtrees():
    for depth in range(1, 6):
        places = [M.address(depth, level, np.arange(8 ** level)) for level in range(depth)]
        assert sorted(np.concatenate(places)) == list(range(M.tree_size(depth)))
    above = 2  # of four levels the upper two come first, then each lower subtree in one stretch
    assert sorted(np.concatenate([M.address(4, level, np.arange(8 ** level)) for level in range(above)])) == list(range(9))
    for s in (0, 5, 63):
        inside = [*M.address(4, 2, np.array([s])), *M.address(4, 3, np.arange(8 * s, 8 * s + 8))]
        assert sorted(inside) == list(range(9 + 9 * s, 18 + 9 * s))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 511, 512])
def test_block_paths_fold_to_its_root(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    depth = M.block_depth(n)
    block = M.Block(M.build_block(leaves, depth), n, depth)
    for i in (0, n // 2, n - 1):
        steps = block.path(i)
        assert M.unpack(M.pack(steps)) == steps
        assert M.fold(leaves[i], steps) == block.node(0, 0)
        assert len(steps) == depth - 1 and all(len(o) < 8 for _, o in steps)


def test_query_equals_a_naive_tree(spark, documents):
    got = sorted((tuple(r) for r in op13_merkle_manifest(spark, "/root/testdata/sf0.01").collect()), key=str)
    want = [(d, h, s, r, p, f, v) for d, h, s, r, p, f, v in by_hand([x.asDict() for x in documents.collect()])]
    assert [(x[0], x[1], x[2], x[3], x[4], x[5], x[6]) for x in got] == want


def test_many_rounds_of_small_blocks(documents):
    assert computed(documents, levels=1) == by_hand([x.asDict() for x in documents.collect()])


def test_odd_documents(odd_documents):
    want = by_hand([x.asDict() for x in odd_documents.collect()])
    assert computed(odd_documents) == want
    assert computed(odd_documents, levels=1) == want


def test_empty_table_and_one_row(odd_documents):
    m = M.build(M.leaf_table(odd_documents.filter("false")))
    assert m.root is None and M.proofs(m).collect() == []
    one = odd_documents.filter("doc_id = 3")
    assert computed(one) == by_hand([x.asDict() for x in one.collect()])


def test_many_groups_and_equal_rows(spark):
    rows = [(i % 40, "T", None if i % 13 == 0 else f"g{i % 70}", "s", 1) for i in range(700)] + [(5, "SAME", "hot", None, None)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    want = by_hand([x.asDict() for x in docs.collect()])
    assert computed(docs, levels=1) == want
    assert computed(docs) == want
