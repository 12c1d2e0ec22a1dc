"""Forests grown inside tasks: against a plain recursion, over passes and partitions, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.plans import forests, models

NAMES = [f"x{i}" for i in range(6)]


def table(spark, n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)).round(2)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 0) + rng.normal(size=n) * 0.7 > 0).astype(float)
    rows = [(i, "abc"[(i % 4) // 2 + (i % 4 == 3)], float(y[i]), *[float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, split string, label double, " + ", ".join(f"{c} double" for c in NAMES))


def plain(codes, y, count, name, depth, config, weights, n_used):
    """One node after the other: (share, left, right, feature, cut)."""
    n, ones = count.sum(), (count * y).sum()
    w1, w0 = weights[1] * ones, weights[0] * (n - ones)

    def spread(k, k1):
        a, b = weights[1] * k1, weights[0] * (k - k1)
        return 2 * a * b / (a + b) if a + b else 0.0

    best = (0.0, None)
    if depth < config.depth and 0 < ones < n:
        for f in forests.chosen(name, codes.shape[1], n_used)[0]:
            for cut in range(forests.BINS):
                m = codes[:, f] <= cut
                ln, l1 = count[m].sum(), (count * y)[m].sum()
                if min(ln, n - ln) >= max(1, config.min_samples_leaf):
                    gain = round((spread(n, ones) - spread(ln, l1) - spread(n - ln, ones - l1)) / (w0 + w1), 12)
                    if gain > best[0]:
                        best = (gain, (f, cut))
    if best[1] is None:
        return w1 / (w0 + w1), w1 > w0, None
    f, cut = best[1]
    m = codes[:, f] <= cut
    sides = [plain(codes[s], y[s], count[s], forests.below(name, np.array([k])), depth + 1, config, weights, n_used) for k, s in ((0, m), (1, ~m))]
    if all(s[2] is None for s in sides) and sides[0][1] == sides[1][1]:
        return w1 / (w0 + w1), w1 > w0, None
    return w1 / (w0 + w1), w1 > w0, (f, cut, *sides)


def share(node, row):
    while node[2] is not None:
        f, cut, left, right = node[2]
        node = left if row[f] <= cut else right
    return node[0]


@pytest.mark.parametrize("config", [forests.Config(1), forests.Config(1, 3, 5), forests.Config(1, None, 4, True)])
def test_a_tree_equals_plain_recursion(config):
    rng = np.random.default_rng(5)
    codes = rng.integers(0, forests.BINS, (300, 5)).astype(np.uint8)
    y = ((codes[:, 0] > 12) ^ (rng.random(300) < 0.25)).astype(float)
    weights = (0.8, 1.3) if config.balanced else (1.0, 1.0)
    for t in range(6):
        count = forests.drawn(np.arange(300, dtype=np.uint64), 1, t).astype(float)
        at = np.flatnonzero(count)
        args = codes[at], y[at], count[at], forests.root(1, t), 0, config, weights, 3
        want = plain(*args)
        assert np.allclose(forests.Tree(*args).shares(codes), [share(want, r) for r in codes])
    assert abs(np.mean([forests.drawn(np.arange(3000, dtype=np.uint64), 1, t).mean() for t in range(20)]) - 1) < 0.02


def test_passes_over_large_nodes_give_the_same_forest(spark, monkeypatch):
    t = table(spark)
    configs = [forests.Config(6), forests.Config(5, 4, 5, True)]
    args = t.where("split = 'a'"), t.where("split <> 'a'"), NAMES, configs, "label", "id", ["id"]

    def probs(*a):
        return {(r.config, r.id): r.y_prob for r in forests.scores(*a).collect()}

    whole = probs(*args)
    assert len(whole) == 2 * t.where("split <> 'a'").count()
    again = probs(args[0].repartition(7), args[1].repartition(3), *args[2:])
    assert again == whole
    monkeypatch.setattr(forests, "NODE_ROWS", 60)
    monkeypatch.setattr(forests, "PASS_CELLS", 3000)
    parts = probs(*args)
    assert parts.keys() == whole.keys()
    # trees that go down to pure leaves; of the others a large node is not merged with its sibling
    assert all(abs(parts[k] - v) < 1e-9 for k, v in whole.items() if k[0] == 0)


def test_sweep_of_forests_scores_without_models_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(models, "make_estimator", None)
    grid = ({"n_estimators": 8, "max_depth": None, "min_samples_leaf": 1, "class_weight": None},
            {"n_estimators": 8, "max_depth": 3, "min_samples_leaf": 5, "class_weight": "balanced"})
    t = table(spark).withColumn("x5", F.when(F.col("id") % 5 != 0, F.col("x5")))
    unknown = t.limit(20).withColumn("label", F.lit(None).cast("double"))
    board = {r.cfg_idx: r for r in models.sweep(t.unionByName(unknown), NAMES, "rf", grid, "id").collect()}
    assert set(board) == {0, 1} and all(r.val_auroc > 0.75 and r.test_auroc > 0.75 for r in board.values())
    with pytest.raises(ValueError, match="training rows"):
        models.sweep(t.where("split <> 'a'"), NAMES, "rf", grid, "id")
