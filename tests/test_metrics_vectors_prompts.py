"""Metrics, clustering/contrastive statistics, profiling and answer parsing."""

import math

from pyspark.sql import functions as F

from hourglass.functions import metrics
from hourglass.operators import profile, prompts, vectors


def test_auroc_tie(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert metrics.ranking_metrics(df, "s", "y").first()["auroc"] == 0.5


def test_auroc_ap(spark):
    df = spark.createDataFrame([(0, .1), (0, .4), (1, .35), (1, .8)], "y int, s double")
    r = metrics.ranking_metrics(df, "s", "y").first()
    assert math.isclose(r["auroc"], 0.75) and math.isclose(r["auprc"], 0.8333333333333333)


def test_binary_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0), (0, 0)], "y int, p int")
    r = metrics.binary_metrics(df, "p", "y").first()
    assert (r["precision"], r["recall"], r["specificity"]) == (0.0, 0.0, 1.0)


def test_failed_answers(spark):
    df = spark.createDataFrame([(1, None)], "label int, pred int")
    assert metrics.fail_as_wrong(df, "pred", "label", "binary").first()["pred"] == 0
    assert metrics.fail_as_wrong(df, "pred", "label", "scale").first()["pred"] == 1


def test_select_best_first_config_on_tie(spark):
    b = spark.createDataFrame([(0, .5, .7), (1, .5, .7)], "cfg_idx int, val_auprc double, val_auroc double")
    assert metrics.select_best(b).first()["cfg_idx"] == 0


def test_early_stopping(spark):
    h = spark.createDataFrame([(i + 1, a, 0.5) for i, a in enumerate([.1, .3, .2, .2, .4])],
                              "epoch int, auprc double, auroc double")
    r = metrics.early_stopping(h, 2).first()
    assert r["stop_epoch"] == 4 and r["best_epoch"] == 2


def test_ari_nmi_identical(spark):
    df = spark.createDataFrame([(0, 5), (0, 5), (1, 7), (1, 7), (2, 9)], "a int, b int")
    r = vectors.contingency_scores(df, "a", "b").first()
    assert math.isclose(r["ari"], 1.0) and math.isclose(r["nmi"], 1.0)


def test_contrastive_identical_views(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], [1.0, 0.0]), (0, [1.0, 0.0], [1.0, 0.0])],
                               "batch_id long, z1 array<double>, z2 array<double>")
    r = vectors.batch_statistics(df, "z1", "z2", tau=0.1).first()
    assert abs(r["alignment"]) < 1e-12 and abs(r["uniformity"]) < 1e-12 and math.isclose(r["collapse"], 1.0)
    assert math.isclose(r["infonce"], math.log(2))


def test_silhouette_matches_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 3))
    lab = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([(x[i].tolist(), int(lab[i])) for i in range(30)], "e array<double>, c int")
    got = vectors.silhouette(df, "e", "c").first()["silhouette"]
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(30):
        own = lab == lab[i]
        a = d[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else None
        b = d[i, ~own].mean()
        s.append(0.0 if a is None else (b - a) / max(a, b))
    assert math.isclose(got, float(np.mean(s)), rel_tol=1e-9)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(41)], "x double")
    h = profile.histogram(df, "x", 40).orderBy("bin").collect()
    assert len(h) == 40 and all(r["count"] == 1 for r in h[:39]) and h[39]["count"] == 2


def test_answer_parsing(spark):
    df = spark.createDataFrame([('ok {"prediction": " Dead "} x',), ('{"prediction":"7"}',), ('{"prediction":11}',),
                                ("no json",)], "t string")
    out = df.select(prompts.parse_binary(F.col("t")).alias("b"), prompts.parse_scale(F.col("t")).alias("s")).collect()
    assert [r["b"] for r in out] == ["dead", None, None, None]
    assert [r["s"] for r in out] == [None, 7, None, None]


def test_format_half_even(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (2.5,)], "x double")
    got = [r[0] for r in df.select(prompts.fmt(F.col("x"), 2)).collect()]
    assert got == [f"{v:.2f}" for v in (0.125, 2.675, 2.5)]
