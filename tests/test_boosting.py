import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.plans import boosting as B
from hourglass.plans import models


def rows_of(seed=3, n=400, missing=0.1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = [round(rng.gauss(0, 1), 1), float(rng.randint(0, 4)), rng.random()]
        y = int(x[0] + 0.5 * x[1] + rng.gauss(0, 0.5) > 1)
        x = [None if rng.random() < missing else math.nan if rng.random() < 0.02 else v for v in x]
        out.append((i, y, *x))
    return out


NAMES = ["x0", "x1", "x2"]
SCHEMA = "id long, label int, x0 double, x1 double, x2 double"


def plain(depth, **kw):
    return B.Config(1, 0.3, depth, subsample=1.0, colsample=1.0, **kw)


def by_hand(codes, g, h, depth, least, l2=1.0):
    """Exhaustive splits of one tree: node -> (feature, cut, missing left), and the leaves' G and H."""
    splits, leaves = {}, {}

    def visit(node, rows):
        G, H = g[rows].sum(), h[rows].sum()
        best = None
        if node < 1 << depth:
            for f in range(codes.shape[1]):
                c = codes[rows, f]
                for cut in sorted(set(c) - {B.MISSING}):
                    for left_missing in (True, False):
                        left = (c <= cut) & (c != B.MISSING) | ((c == B.MISSING) & left_missing)
                        GL, HL = g[rows][left].sum(), h[rows][left].sum()
                        GR, HR = G - GL, H - HL
                        if min(HL, HR) < least or left.all() or not left.any():
                            continue
                        gain = GL ** 2 / (HL + l2) + GR ** 2 / (HR + l2) - G ** 2 / (H + l2)
                        key = (round(gain, 9), -f, -cut, left_missing)
                        if gain > B.LEAST_GAIN and (best is None or key > best[0]):
                            best = (key, f, cut, left_missing, left)
        if best is None:
            leaves[node] = (G, H)
            return
        splits[node] = best[1:4]
        visit(2 * node, rows[best[4]])
        visit(2 * node + 1, rows[~best[4]])

    visit(1, np.arange(len(g)))
    return splits, leaves


@pytest.mark.parametrize("depth,least,weight", [(1, 1.0, 1.0), (3, 1.0, 1.0), (4, 5.0, 2.5), (2, 0.0, 0.4)])
def test_one_tree_equals_exhaustive_splits(spark, depth, least, weight):
    df = spark.createDataFrame(rows_of(), SCHEMA).repartition(5)
    fitted = B.fit(df, NAMES, [plain(depth, min_child_weight=least, scale_pos_weight=weight)])
    rows = B.binned(df, NAMES, fitted.edges, ["id", "label"]).orderBy("id").collect()
    codes = np.array([list(r.bins) for r in rows])
    y = np.array([r.label for r in rows], float)
    w = np.where(y == 1, weight, 1.0)
    splits, leaves = by_hand(codes, w * (0.5 - y), w * 0.25, depth, least)
    tree = fitted.trees[0][0]
    got = {i: (int(tree.feature[i]), int(tree.cut[i]), bool(tree.missing_left[i])) for i in np.flatnonzero(tree.feature >= 0)}
    assert got == splits
    for node, (G, H) in leaves.items():
        assert tree.weight[node] == pytest.approx(-0.3 * G / (H + 1))


def test_bins_keep_every_distinct_value_apart(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    edges = B.bin_edges(df, NAMES)
    codes = {(r.x1, r.bins[1]) for r in B.binned(df, NAMES, edges, ["x1"]).collect()}
    present = {c for v, c in codes if v is not None and not math.isnan(v)}
    assert len(present) == 5 and {c for v, c in codes if v is None or math.isnan(v)} == {B.MISSING}


def test_shared_passes_do_not_mix_configs_or_subsets(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA).withColumn("m", F.when(F.col("id") % 3 == 0, 3).otherwise(1)).repartition(3)
    many = [B.Config(5, 0.3, 2), B.Config(3, 0.1, 3, min_child_weight=3, scale_pos_weight=2.0), B.Config(4, 0.3, 2, subset=1)]
    together = B.fit(df, NAMES, many, member_col="m")
    assert together.passes <= 5 * 3
    for i, c in enumerate(many):
        alone = B.fit(df, NAMES, [c], member_col="m")
        assert len(alone.trees[0]) == c.n_estimators
        for a, b in zip(alone.trees[0], together.trees[i], strict=True):
            assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.weight, b.weight)


def test_partitioning_and_written_margins_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    one = B.fit(df.coalesce(1), NAMES, [B.Config(6, 0.3, 3)])
    monkeypatch.setattr(B, "STATE_EVERY", 2)
    monkeypatch.setattr(B, "SUMS_PER_TASK", 50)
    other = B.fit(df.repartition(7), NAMES, [B.Config(6, 0.3, 3)])
    for a, b in zip(one.trees[0], other.trees[0], strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.weight, b.weight)


def test_scores_are_the_sum_of_the_trees_and_rank_well(spark):
    df = spark.createDataFrame(rows_of(n=600, missing=0.02), SCHEMA)
    fitted = B.fit(df.where("id < 400"), NAMES, [B.Config(20, 0.3, 3)])
    scored = fitted.score(df.where("id >= 400"), ["id", "label"])
    from hourglass.functions import metrics
    m = metrics.ranking_metrics(scored, "y_prob", "label").first()
    assert m["auroc"] > 0.9
    assert scored.count() == 200 and scored.where("y_prob <= 0 or y_prob >= 1").isEmpty()


def test_one_class_no_rows_and_null_labels(spark):
    df = spark.createDataFrame(rows_of(n=50), SCHEMA)
    ones = B.fit(df.withColumn("label", F.lit(1)), NAMES, [B.Config(2, 0.3, 2, min_child_weight=1)])
    assert (ones.trees[0][0].feature == -1).all() and ones.trees[0][0].weight[1] > 0
    empty = B.fit(df.where("false"), NAMES, [B.Config(2, 0.3, 2)])
    assert [r.y_prob for r in empty.score(df, ["id"]).limit(2).collect()] == [0.5, 0.5]
    half = df.withColumn("label", F.when(F.col("id") % 2 == 0, F.col("label")))
    a, b = B.fit(half, NAMES, [plain(2)]), B.fit(half.where("label is not null"), NAMES, [plain(2)])
    assert (a.trees[0][0].feature == b.trees[0][0].feature).all()


def test_sweep_predictions_and_scarcity(spark):
    rows = [(i, "abc"[min(i % 4, 2) if i % 4 else 0], y, *x) for i, y, *x in rows_of(n=240)]
    t = spark.createDataFrame(rows, "id long, split string, label int, x0 double, x1 double, x2 double")
    grid = ({"n_estimators": 3, "learning_rate": 0.3, "max_depth": 2, "min_child_weight": 1, "scale_pos_weight": 1.0},
            {"n_estimators": 2, "learning_rate": 0.3, "max_depth": 3, "min_child_weight": 1, "scale_pos_weight": None})
    board = models.sweep(t, NAMES, "gbt", models.gbt_grid(0.7, grid), "id").collect()
    assert [r.cfg_idx for r in sorted(board, key=lambda r: r.cfg_idx)] == [0, 1] and all(r.val_auroc > 0.7 for r in board)
    p = models.predictions(t, NAMES, "gbt", models.gbt_grid(0.7, grid)[0], "id")
    assert p.columns == ["id", "split", "y_true", "y_prob"] and p.count() == 240
    emb = t.select("id", "split", "label", F.array(F.coalesce(F.nanvl("x0", F.lit(0.0)), F.lit(0.0)), F.col("id") % 7 + 0.0).alias("embedding"))
    got = {(r.n_labelled, r.model) for r in models.label_scarcity(emb, t, NAMES, (20, 1000), "id", grid=grid).collect()}
    assert got == {(n, m) for n in ("20", "1000", "full") for m in ("lr", "gbt")}
