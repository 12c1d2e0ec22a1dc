"""Boosting: nodes with few rows are finished in one pass (F1, F2, F5), nodes with many rows level by level."""

import numpy as np
import pytest
from test_boosting import NAMES, SCHEMA, rows_of

from hourglass.plans import boosting as B

CONFIGS = [B.Config(4, 0.3, 4), B.Config(2, 0.1, 3, min_child_weight=3, scale_pos_weight=2.0)]


def test_a_round_of_small_nodes_is_one_pass(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA).repartition(3)
    assert B.fit(df, NAMES, CONFIGS).passes == 4


@pytest.mark.parametrize("rows", [0, 120])
def test_the_size_of_nodes_changes_no_tree(spark, monkeypatch, rows):
    df = spark.createDataFrame(rows_of(), SCHEMA).repartition(3)
    whole = B.fit(df, NAMES, CONFIGS)
    monkeypatch.setattr(B, "NODE_BYTES", rows * 18)
    other = B.fit(df, NAMES, CONFIGS)
    # with 120 rows upper levels are summed over all tasks and lower ones finished by one
    assert other.passes > whole.passes
    for many, few in zip(whole.trees, other.trees, strict=True):
        for a, b in zip(many, few, strict=True):
            assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.missing_left == b.missing_left).all()
            assert np.allclose(a.weight, b.weight)


def test_trees_side_by_side_reach_the_nodes_of_single_trees(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    fitted = B.fit(df, NAMES, [B.Config(5, 0.3, 3)])
    codes = np.array([list(r.bins) for r in B.binned(df, NAMES, fitted.edges, ["id"]).collect()], np.uint8)
    forest, margin = B.Forest(fitted.trees[0]), np.zeros(len(codes))
    forest.add_margins(codes, margin)
    by_hand = np.zeros(len(codes))
    for t in fitted.trees[0]:
        for i, row in enumerate(codes):
            node = 1
            while t.feature[node] >= 0:
                b = row[t.feature[node]]
                node = 2 * node + int(not (t.missing_left[node] if b == B.MISSING else b <= t.cut[node]))
            by_hand[i] += t.weight[node]
    assert np.allclose(margin, by_hand)
