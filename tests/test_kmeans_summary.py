"""V5 restarts in shared scans; S9 one nested document, published at once."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import vectors as V
from hourglass.sources import sinks


def blobs(seed=0, n=300, dim=5, k=3):
    rng = np.random.default_rng(seed)
    mid = rng.normal(0, 6, (k, dim))
    which = rng.integers(0, k, n)
    return mid[which] + rng.normal(0, 1, (n, dim)), which


def lloyd(x, centers, tol=1e-4):
    """Plain Lloyd iterations from given centers."""
    while True:
        d = ((x[:, None] - centers) ** 2).sum(2)
        near = d.argmin(1)
        after = np.array([x[near == j].mean(0) if (near == j).any() else c for j, c in enumerate(centers)])
        if np.sqrt(((after - centers) ** 2).sum(1)).max() <= tol:
            return d.min(1).sum(), centers
        centers = after


@pytest.fixture(scope="module")
def points(spark):
    x, which = blobs()
    return x, which, spark.createDataFrame([(i, r.tolist(), int(w)) for i, (r, w) in enumerate(zip(x, which, strict=True))],
                                           "id long, embedding array<double>, label int").repartition(5).persist()


def test_restarts_together_equal_single_fits_and_plain_lloyd(points, monkeypatch):
    x, _, df = points
    starts = {}
    real = V._per_restart

    def spy(rows, centers, sums):
        if sums and not starts:
            starts.update({r: c.copy() for r, c in enumerate(centers)})
        return real(rows, centers, sums)

    monkeypatch.setattr(V, "_per_restart", spy)
    together = V.kmeans_fits(df, k=3, n_init=4, seed=7)
    assert len({tuple(c[0]) for c in starts.values()}) > 1  # different restarts start apart
    for r, (cost, centers) in enumerate(together):
        assert all((x == c).all(1).any() for c in starts[r])  # from rows of the table
        want = lloyd(x, starts[r])
        assert cost == pytest.approx(want[0]) and np.allclose(centers, want[1])
    monkeypatch.setattr(V, "_per_restart", real)
    alone = V.kmeans_fits(df.coalesce(1), k=3, n_init=1, seed=7)
    assert alone[0][0] == pytest.approx(together[0][0])


def test_one_scan_per_iteration_for_all_restarts(points, monkeypatch):
    scans = []
    real = V._per_restart
    monkeypatch.setattr(V, "_per_restart", lambda *a, **k: scans.append(1) or real(*a, **k))
    V.kmeans_fits(points[2], k=2, n_init=6, seed=1)
    many, scans[:] = len(scans), []
    one = []
    for i in range(2):
        V.kmeans_fits(points[2], k=2, n_init=1, seed=1 + i)
        one.append(len(scans))
    assert many < 6 * min(one)


def test_clusters_are_the_blobs(points):
    _, which, df = points
    got = {r.id: r.cluster for r in V.kmeans_restarts(df, k=3, n_init=5).collect()}
    assert len({(w, got[i]) for i, w in enumerate(which)}) == 3
    assert V.contingency_scores(V.kmeans_restarts(df, k=3, n_init=5), "label", "cluster").first()["ari"] == pytest.approx(1.0)


def test_few_rows_null_vectors_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], "id long, embedding array<double>")
    fits = V.kmeans_fits(df, k=3, n_init=2)
    assert all(cost == pytest.approx(0) and len(c) == 1 for cost, c in fits)
    assert {r.id: r.cluster for r in V.kmeans_restarts(df, k=3, n_init=2).collect()} == {1: 0, 2: 0, 3: None}
    assert V.kmeans_fits(df.where("false"), k=2, n_init=2) == []


def test_summary_document_is_nested_finite_and_replaced_at_once(spark, tmp_path):
    inf = float("inf")
    table = spark.createDataFrame([(1, float("nan"), [1.0, inf], (2.0, inf), {"a": inf, "b": 1.0}), (2, None, None, None, None)],
                                  "i int, x double, xs array<double>, s struct<u: double, v: double>, m map<string, double>")
    values = {"run": {"name": "é", "scores": [1, 2.5, float("nan"), np.float64("inf")], "matrix": np.eye(2)}, "none": None}
    path = str(tmp_path / "out" / "summary.json")
    sinks.write_summary_document(spark, path, values, {"rows": table, "empty": table.where("false")})
    doc = json.load(open(path, encoding="utf-8"))
    assert doc == {"run": {"name": "é", "scores": [1, 2.5, None, None], "matrix": [[1.0, 0.0], [0.0, 1.0]]}, "none": None, "empty": [],
                   "rows": [{"i": 1, "x": None, "xs": [1.0, None], "s": {"u": 2.0, "v": None}, "m": {"a": None, "b": 1.0}},
                            {"i": 2, "x": None, "xs": None, "s": None, "m": None}]}
    sinks.write_summary_document(spark, path, {"second": 1}, {})
    assert json.load(open(path)) == {"second": 1}
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")] == ["summary.json"]


def test_a_failed_summary_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "summary.json")
    sinks.write_summary_document(spark, path, {"a": 1}, {})
    with pytest.raises(ValueError, match="more than 3 rows"):
        sinks.summary_document({}, {"t": spark.range(4)}, max_rows=3)
    with pytest.raises(ValueError, match="both"):
        sinks.write_summary_document(spark, path, {"t": 1}, {"t": spark.range(1)})
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_summary_document(spark, path, {}, {"t": broken})
    assert json.load(open(path)) == {"a": 1}
