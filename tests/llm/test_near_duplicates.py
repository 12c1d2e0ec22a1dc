"""Operator 2 against all pairs, and its parts."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.llm import graph, lsh_forest, queries

SF = "/root/testdata/sf0.01"


def sets_of(text, width=3):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(texts, percent=85):
    """{id: smallest id reachable} by comparing all pairs (of sets that share a shingle)."""
    sets = {i: sets_of(t) for i, t in texts.items()}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in sets.items():
        shared = {}
        for x in s:
            for j in index[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_near_duplicates_query_equals_all_pairs(spark, texts):
    rows = queries.op2_near_duplicates(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and not all(r.kept for r in rows)


def test_a_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "BLOCK", 16)
    pick = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = {}
    for i in range(150):
        words = list(base)
        for _ in range(pick.randrange(6)):
            words[pick.randrange(120)] = f"x{pick.randrange(40)}"
        rows[i] = " ".join(words)
    rows |= {200 + i: " ".join(pick.choice(base) for _ in range(80)) for i in range(40)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in lsh_forest.near_duplicates(docs).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) > 41


def test_near_duplicates_odd_rows(spark, odd_documents):
    rows = lsh_forest.near_duplicates(odd_documents).collect()
    found = sorted((r.doc_id or 0, r.component_id or 0, r.kept, r.n_shingles) for r in rows)
    assert found == sorted([(1, 1, True, 2), (1, 1, True, 2), (2, 2, True, 0), (3, 3, True, 0), (4, 4, True, 0), (0, 0, True, 1),
                            (5, 5, True, 977), (6, 5, False, 977), (7, 7, True, 1), (8, 8, True, 4), (9, 1, False, 2)])
    assert lsh_forest.near_duplicates(odd_documents.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=2, max_size=8), st.sampled_from([50, 80, 85, 100]))
def test_linked_pairs_are_exact(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    want = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    assert sorted(map(tuple, lsh_forest.linked_pairs(arrays, percent).tolist())) == want


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = list(zip(order, order[1:], strict=False)) + [(1000, 1001), (1001, 1001)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(300), 0), 1000: 1000, 1001: 1000}
