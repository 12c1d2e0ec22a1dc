"""Queries without SQL against known solutions: logistic regression (M1, M4, M5, M16), forests (M2), PCA (V15), X/y."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.functions import metrics
from hourglass.operators import features, vectors
from hourglass.plans import models


def newton(x, y, c, weight=None):
    """Minimum of Σ w·logloss + ‖b‖² / 2C (the intercept is free)."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.ones(len(x)) if weight is None else weight
    ridge = np.diag([1 / c] * x.shape[1] + [0.0])
    b = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ b))
        b -= np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (w * (p - y)) + ridge @ b)
    return b


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(360, 3))
    y = (x @ [1.5, -1.0, 0.3] + rng.normal(size=360) > 0.4).astype(int)
    split = np.array(list("aabc"))[np.arange(360) % 4]
    df = spark.createDataFrame([(i, str(split[i]), int(y[i]), *map(float, x[i])) for i in range(360)],
                               "id long, split string, label int, x0 double, x1 double, x2 double").repartition(4).persist()
    return x, y, split, df


NAMES = ["x0", "x1", "x2"]


@pytest.mark.parametrize("cfg", [models.LR_GRID[0], models.LR_GRID[2], models.LR_GRID[7]])
def test_logistic_regression_is_the_penalised_optimum(data, cfg):
    x, y, split, df = data
    tr = split == "a"
    weight = None
    if cfg["class_weight"] == "balanced":
        n = np.bincount(y[tr])
        weight = tr.sum() / (2 * n[y[tr]])
        # the mean of the loss is over the weights, which sum to the number of rows
    b = newton(x[tr], y[tr], cfg["C"], weight)
    want = 1 / (1 + np.exp(-(x @ b[:3] + b[3])))
    got = {r.id: r.y_prob for r in models.predictions(df, NAMES, "lr", cfg, "id").collect()}
    assert max(abs(got[i] - want[i]) for i in range(360)) < 2e-3


def test_sweep_scores_are_those_of_the_optimum(data):
    x, y, split, df = data
    tr = split == "a"
    board = {r.cfg_idx: r for r in models.sweep(df, NAMES, "lr", models.LR_GRID[:3], "id").collect()}
    for i, cfg in enumerate(models.LR_GRID[:3]):
        b = newton(x[tr], y[tr], cfg["C"])
        for s, name in (("b", "val_auroc"), ("c", "test_auroc")):
            assert board[i][name] == pytest.approx(auc(y[split == s], x[split == s] @ b[:3]), abs=0.01)


def test_probe_with_threshold_counts_the_optimum(data):
    x, y, split, df = data
    tr, ev = split == "a", split == "c"
    b = newton(x[tr], y[tr], 1.0)
    p = 1 / (1 + np.exp(-(x[ev] @ b[:3] + b[3])))
    emb = df.select("id", "split", "label", F.array(*NAMES).alias("embedding"))
    r = models.linear_probe(emb, "a", "c", threshold=0.5).first()
    assert (r["n_train"], r["n_eval"]) == (tr.sum(), ev.sum())
    assert r["auroc"] == pytest.approx(auc(y[ev], p), abs=0.005)
    assert abs(r["tp"] - ((p >= 0.5) & (y[ev] == 1)).sum()) <= 1 and abs(r["fp"] - ((p >= 0.5) & (y[ev] == 0)).sum()) <= 1


def test_forest_learns_an_interaction_that_no_line_separates(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (600, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(i, "aabc"[i % 4], int(y[i]), *map(float, x[i])) for i in range(600)],
                               "id long, split string, label int, x0 double, x1 double")
    small = ({"n_estimators": 20, "max_depth": 6, "min_samples_leaf": 1, "class_weight": None},)
    assert models.sweep(df, ["x0", "x1"], "rf", small, "id").first()["test_auroc"] > 0.95
    assert models.sweep(df, ["x0", "x1"], "lr", models.LR_GRID[:1], "id").first()["test_auroc"] < 0.7


def test_pca_equals_the_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 5)) * [5, 3, 1, 0.5, 0.1] + 2
    x = x @ np.linalg.qr(rng.normal(size=(5, 5)))[0]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, embedding array<double>").repartition(3)
    _, v = np.linalg.eigh(np.cov(x.T))
    v = v[:, ::-1][:, :2]
    v = v * np.sign(v[np.abs(v).argmax(0), range(2)])
    got = np.array([r.projection for r in vectors.pca_2d(df).orderBy("id").collect()])
    assert np.allclose(got, x @ v, atol=1e-6)


def test_x_y_projection_keeps_order_and_missing_values(spark):
    df = spark.createDataFrame([(1, 2.0, None, 0), (3, 4.0, 5.0, 1)], "b int, a double, c double, label int")
    rows = features.assemble(df, ["c", "a", "b"]).orderBy("label").collect()
    assert np.isnan(rows[0].features[0]) and rows[0].features.toArray()[1:].tolist() == [2.0, 1.0]
    assert rows[1].features.toArray().tolist() == [5.0, 4.0, 3.0] and rows[1].label == 1.0


def test_ranking_metrics_of_the_scored_rows(data):
    x, y, _, df = data
    m = metrics.ranking_metrics(df.select(F.col("x0").alias("s"), "label"), "s", "label").first()
    assert m["auroc"] == pytest.approx(auc(y, x[:, 0]))
