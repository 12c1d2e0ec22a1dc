"""Model fitting and evaluation with Spark ML.

A sweep is a config table (M20) with ``cfg_idx``; each config is one Spark ML fit on the train split
(features assembled once and persisted), scored on validation ∪ test as soon as it is fitted and evaluated
with the exact metrics of :mod:`hourglass.functions.metrics`, grouped by split (M17). Boosted configs are
fitted together over shared scans (:mod:`hourglass.plans.boosting`). Learners differ
from liblinear / sklearn forests / xgboost, so scores are comparable in quality, not bit-equal.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import metrics
from hourglass.operators.features import assemble
from hourglass.plans import boosting, forests
from hourglass.session import cut_lineage, reuse, small_side

# The classical sweeps.
LR_GRID = (
    {"C": 0.01, "class_weight": None}, {"C": 0.1, "class_weight": None},
    {"C": 1.0, "class_weight": None}, {"C": 10.0, "class_weight": None},
    {"C": 0.01, "class_weight": "balanced"}, {"C": 0.1, "class_weight": "balanced"},
    {"C": 1.0, "class_weight": "balanced"}, {"C": 10.0, "class_weight": "balanced"},
)
RF_GRID = (
    {"n_estimators": 200, "max_depth": None, "min_samples_leaf": 1, "class_weight": None},
    {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 1, "class_weight": None},
    {"n_estimators": 300, "max_depth": 10, "min_samples_leaf": 1, "class_weight": None},
    {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 5, "class_weight": None},
    {"n_estimators": 200, "max_depth": None, "min_samples_leaf": 1, "class_weight": "balanced"},
    {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 1, "class_weight": "balanced"},
    {"n_estimators": 300, "max_depth": 10, "min_samples_leaf": 1, "class_weight": "balanced"},
    {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 5, "class_weight": "balanced"},
)
# None stands for the negatives-to-positives ratio of the training rows.
GBT_GRID = (
    {"n_estimators": 100, "learning_rate": 0.05, "max_depth": 3, "min_child_weight": 1, "scale_pos_weight": 1.0},
    {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 4, "min_child_weight": 1, "scale_pos_weight": 1.0},
    {"n_estimators": 300, "learning_rate": 0.03, "max_depth": 4, "min_child_weight": 1, "scale_pos_weight": 1.0},
    {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 6, "min_child_weight": 3, "scale_pos_weight": 1.0},
    {"n_estimators": 100, "learning_rate": 0.05, "max_depth": 3, "min_child_weight": 1, "scale_pos_weight": None},
    {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 4, "min_child_weight": 1, "scale_pos_weight": None},
    {"n_estimators": 300, "learning_rate": 0.03, "max_depth": 4, "min_child_weight": 1, "scale_pos_weight": None},
    {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 6, "min_child_weight": 3, "scale_pos_weight": None},
)
RF_ENGINEERED_GRID = (
    {"n_estimators": 300, "max_depth": 10, "min_samples_leaf": 1, "class_weight": None},
    {"n_estimators": 300, "max_depth": 10, "min_samples_leaf": 5, "class_weight": None},
    {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 5, "class_weight": None},
    {"n_estimators": 500, "max_depth": 10, "min_samples_leaf": 1, "class_weight": None},
    {"n_estimators": 300, "max_depth": 10, "min_samples_leaf": 1, "class_weight": "balanced"},
    {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 5, "class_weight": "balanced"},
)
# Experiments whose models are trained elsewhere; their tables feed the leaderboards.
SEQUENCE_GRID = (
    {"name": "uni_last", "bidirectional": False, "pooling": "last"},
    {"name": "uni_mean", "bidirectional": False, "pooling": "mean"},
    {"name": "uni_recency_2", "bidirectional": False, "pooling": "recency", "strength": 2},
    {"name": "uni_recency_3", "bidirectional": False, "pooling": "recency", "strength": 3},
    {"name": "uni_recency_4", "bidirectional": False, "pooling": "recency", "strength": 4},
    {"name": "bi_last", "bidirectional": True, "pooling": "last"},
    {"name": "bi_mean", "bidirectional": True, "pooling": "mean"},
    {"name": "bi_max", "bidirectional": True, "pooling": "max"},
    {"name": "bi_recency_0", "bidirectional": True, "pooling": "recency", "strength": 0},
    {"name": "bi_recency_1", "bidirectional": True, "pooling": "recency", "strength": 1},
    {"name": "bi_recency_2", "bidirectional": True, "pooling": "recency", "strength": 2},
    {"name": "bi_recency_3", "bidirectional": True, "pooling": "recency", "strength": 3},
    {"name": "bi_recency_4", "bidirectional": True, "pooling": "recency", "strength": 4},
    {"name": "bi_recency_5", "bidirectional": True, "pooling": "recency", "strength": 5},
    {"name": "bi_recency_6", "bidirectional": True, "pooling": "recency", "strength": 6},
    {"name": "bi_mean_mask_delta", "bidirectional": True, "pooling": "mean", "mask_delta": True},
)
TRANSFORMER_GRID = (
    {"name": "transformer_d64_h4_l1_ff128_do02", "d_model": 64, "nhead": 4, "num_layers": 1, "dim_feedforward": 128, "dropout": 0.2},
    {"name": "transformer_d64_h4_l2_ff128_do02", "d_model": 64, "nhead": 4, "num_layers": 2, "dim_feedforward": 128, "dropout": 0.2},
    {"name": "transformer_d128_h4_l2_ff256_do02", "d_model": 128, "nhead": 4, "num_layers": 2, "dim_feedforward": 256, "dropout": 0.2},
    {"name": "transformer_d128_h8_l2_ff256_do02", "d_model": 128, "nhead": 8, "num_layers": 2, "dim_feedforward": 256, "dropout": 0.2},
    {"name": "transformer_d64_h4_l2_ff128_do01", "d_model": 64, "nhead": 4, "num_layers": 2, "dim_feedforward": 128, "dropout": 0.1},
    {"name": "transformer_d64_h4_l2_ff128_do03", "d_model": 64, "nhead": 4, "num_layers": 2, "dim_feedforward": 128, "dropout": 0.3},
)
GBT_SUBSAMPLE = 0.8
GBT_COLSAMPLE = 0.8
FIT_ROWS = 2000  # rows of a fit's partition, at least
MOST_FIT_ROWS = 200_000
DRIVER_NODES = 4_000_000  # tree nodes of the forests that grow at the same time
UNLIMITED_DEPTH = 30  # Spark's deepest tree stands in for "no depth limit"
SEED = 42


def gbt_grid(pos_weight: float, grid=GBT_GRID) -> tuple:
    """The boosting configs with the ratio n_neg / n_pos filled in."""
    return tuple({**c, "scale_pos_weight": float(pos_weight) if c["scale_pos_weight"] is None else c["scale_pos_weight"]} for c in grid)


def config_table(spark, model: str, grid) -> DataFrame:
    """The experiment grid as a DataFrame ``(model, cfg_idx, config json)``."""
    return spark.createDataFrame([(model, i, json.dumps(c, sort_keys=True)) for i, c in enumerate(grid)],
                                 "model string, cfg_idx int, config string")


def experiment_grid(panel: DataFrame, n_features: int, id_col: str, label: str = "label", split_col: str = "split") -> DataFrame:
    """Every experiment of the study with its input: ``(model, cfg_idx, config, n_features, n_train, n_val,
    n_test)``. Sequences with mask and time-since-observation are three times as wide."""
    spark = panel.sparkSession
    grids = (("lstm", SEQUENCE_GRID), ("transformer", TRANSFORMER_GRID), ("lr", LR_GRID), ("rf", RF_GRID), ("gbt", GBT_GRID),
             ("rf_engineered", RF_ENGINEERED_GRID))
    rows = None
    for model, g in grids:
        t = config_table(spark, model, g)
        rows = t if rows is None else rows.unionByName(t)
    ids = panel.where(F.col(label).isNotNull()).select(id_col, split_col).distinct().groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    n = {r[0]: r[1] for r in ids.where(F.col(split_col).isin("a", "b", "c")).collect()}
    wide = F.coalesce(F.get_json_object("config", "$.mask_delta"), F.lit("false")) == "true"
    return rows.select("*", F.when(wide, 3 * n_features).otherwise(n_features).alias("n_features"),
                       *[F.lit(int(n.get(s, 0))).cast("long").alias(c) for s, c in (("a", "n_train"), ("b", "n_val"), ("c", "n_test"))])


def with_weights(df: DataFrame, label: str, mode: str | None, pos_weight: float = 1.0) -> DataFrame:
    """Sample weights: ``balanced`` = n / (2 · n_class); ``pos`` = pos_weight on positives; else 1."""
    if mode == "balanced":
        c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
        n = df.count()
        return df.join(small_side(c), label).withColumn("_w", F.lit(float(n)) / (F.lit(2.0) * F.col("_nc"))).drop("_nc")
    if mode == "pos":
        return df.withColumn("_w", F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))
    return df.withColumn("_w", F.lit(1.0))


def make_estimator(model: str, cfg: dict, n_train: int):
    if model == "lr":
        return LogisticRegression(featuresCol="features", labelCol="label", weightCol="_w",
                                  regParam=1.0 / (cfg["C"] * n_train), elasticNetParam=0.0,
                                  standardization=False, maxIter=1000, tol=1e-6)
    if model == "rf":
        return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="_w",
                                      numTrees=cfg["n_estimators"], maxDepth=cfg["max_depth"] or UNLIMITED_DEPTH,
                                      minInstancesPerNode=cfg["min_samples_leaf"], featureSubsetStrategy="sqrt",
                                      seed=SEED)
    raise ValueError(f"unknown model {model}")


def weight_mode(model: str, cfg: dict) -> tuple[str | None, float]:
    return cfg.get("class_weight"), 1.0


def booster(cfg: dict, subset: int = 0) -> boosting.Config:
    """A boosting config of the grid, with the ratio of the classes filled in, over one subset of the training rows."""
    return boosting.Config(cfg["n_estimators"], cfg["learning_rate"], cfg["max_depth"], cfg["min_child_weight"],
                           cfg["scale_pos_weight"], subset, GBT_SUBSAMPLE, GBT_COLSAMPLE, SEED)


def positive_prob() -> F.Column:
    """Probability of class 1."""
    return vector_to_array(F.col("probability"))[1]


def fit_many(estimators: list, data: list, parallelism: int = 8) -> list:
    """Fit several estimators concurrently (like CrossValidator's ``parallelism``): each fit is a
    sequence of Spark jobs; the scheduler runs jobs from different threads side by side."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(estimators)))) as ex:
        return list(ex.map(lambda p: p[0].fit(p[1]), zip(estimators, data)))


def sweep(table: DataFrame, feature_cols: list[str], model: str, grid, id_col: str, split_col: str = "split",
          train: str = "a", evals=("b", "c"), label: str = "label", parallelism: int = 8) -> DataFrame:
    """M1–M3 + M17: fit every config on the train split (concurrently), score validation and test, and
    evaluate all configs in one grouped metrics pass: one leaderboard row per config
    ``(model, cfg_idx, config, val_auroc, val_auprc, test_auroc, test_auprc)``."""
    score = {"gbt": _boosted, "rf": _forests}.get(model, _fitted)
    scored = score(table.where(F.col(label).isNotNull()), feature_cols, model, grid, id_col, split_col, train, evals, label, parallelism)
    m = metrics.ranking_metrics(scored, "y_prob", label, ["cfg_idx", split_col])
    board = m.groupBy("cfg_idx").agg(
        F.max(F.when(F.col(split_col) == evals[0], F.col("auroc"))).alias("val_auroc"),
        F.max(F.when(F.col(split_col) == evals[0], F.col("auprc"))).alias("val_auprc"),
        F.max(F.when(F.col(split_col) == evals[1], F.col("auroc"))).alias("test_auroc"),
        F.max(F.when(F.col(split_col) == evals[1], F.col("auprc"))).alias("test_auprc"))
    cfgs = table.sparkSession.createDataFrame(
        [(model, i, json.dumps(c, sort_keys=True)) for i, c in enumerate(grid)], "model string, cfg_idx int, config string")
    return cfgs.join(board, "cfg_idx", "left").select("model", "cfg_idx", "config", "val_auroc", "val_auprc",
                                                      "test_auroc", "test_auprc")


def _tasks(n_rows: int, spark) -> int:
    """Partitions of rows that fits read many times: a task costs more than its rows below ``FIT_ROWS`` of them."""
    return max(1, min(n_rows // FIT_ROWS, 2 * spark.sparkContext.defaultParallelism), n_rows // MOST_FIT_ROWS)


def _at_once(grid, n_train: int, parallelism: int) -> int:
    """How many forests may be grown at the same time: their nodes are held by the driver until they have scored."""
    nodes = [c.get("n_estimators", 0) * min(2 << (c.get("max_depth") or UNLIMITED_DEPTH), 2 * max(n_train, 1) // c.get("min_samples_leaf", 1))
             for c in grid]
    return max(1, min(parallelism, len(grid), DRIVER_NODES // max(1, *nodes)))


def _fitted(table, feature_cols, model, grid, id_col, split_col, train, evals, label, parallelism) -> DataFrame:
    """``cfg_idx``, split, label and ``y_prob`` of the evaluation rows: one Spark ML fit per config.

    A config's scores are written as soon as it is fitted: Spark ships a model inside the tasks that score with it, so
    one plan over all configs would send every task every model, and the driver would hold all of them."""
    from concurrent.futures import ThreadPoolExecutor

    rows = reuse(table.select(id_col, split_col, label, *feature_cols))
    data = reuse(assemble(rows, feature_cols, label).select(id_col, split_col, "features", label)
                 .repartition(_tasks(rows.count(), table.sparkSession)))
    tr = data.where(F.col(split_col) == train)
    ev = data.where(F.col(split_col).isin(*evals))
    n_train = tr.count()

    def scores(i: int) -> DataFrame:
        mode, pw = weight_mode(model, grid[i])
        fitted = make_estimator(model, grid[i], n_train).fit(with_weights(tr, label, mode, pw))
        return cut_lineage(fitted.transform(ev).select(F.lit(i).alias("cfg_idx"), split_col, label, positive_prob().alias("y_prob")))

    with ThreadPoolExecutor(max_workers=_at_once(grid, n_train, parallelism)) as ex:
        parts = list(ex.map(scores, range(len(grid))))
    rows.unpersist()
    scored = parts[0]
    for s in parts[1:]:
        scored = scored.unionByName(s)
    return scored


def _forests(table, feature_cols, model, grid, id_col, split_col, train, evals, label, parallelism) -> DataFrame:
    """The same of forests, whose trees are grown and scored inside tasks."""
    data = reuse(table.select(id_col, split_col, F.col(label).cast("double").alias(label), *feature_cols))
    configs = [forests.Config(c["n_estimators"], c["max_depth"], c["min_samples_leaf"], c["class_weight"] == "balanced", SEED) for c in grid]
    scored = forests.scores(data.where(F.col(split_col) == train), data.where(F.col(split_col).isin(*evals)), list(feature_cols),
                            configs, label, id_col, [split_col, label])
    data.unpersist()
    return scored.withColumnRenamed("config", "cfg_idx")


def _boosted(table, feature_cols, model, grid, id_col, split_col, train, evals, label, parallelism) -> DataFrame:
    """The same of boosted configs, which share their scans."""
    data = reuse(table.select(id_col, split_col, F.col(label).cast("double").alias(label), *feature_cols))
    fitted = boosting.fit(data.where(F.col(split_col) == train), feature_cols, [booster(c) for c in grid], label, id_col)
    ev = data.where(F.col(split_col).isin(*evals))
    return fitted.score(ev, [split_col, label]).withColumnRenamed("config", "cfg_idx")


def predictions(table: DataFrame, feature_cols: list[str], model: str, cfg: dict, id_col: str,
                split_col: str = "split", train: str = "a", label: str = "label") -> DataFrame:
    """Fit one config and score every row: ``(id, split, y_true, y_prob)``."""
    if model == "gbt":
        labelled = table.where(F.col(label).isNotNull())
        fitted = boosting.fit(labelled.where(F.col(split_col) == train), feature_cols, [booster(cfg)], label, id_col)
        return fitted.score(labelled, [id_col, split_col, label]).select(
            id_col, split_col, F.col(label).cast("int").alias("y_true"), "y_prob")
    data = assemble(table.where(F.col(label).isNotNull()), feature_cols, label)
    tr = data.where(F.col(split_col) == train)
    mode, pw = weight_mode(model, cfg)
    fitted = make_estimator(model, cfg, tr.count()).fit(with_weights(tr, label, mode, pw))
    return fitted.transform(data).select(id_col, split_col, F.col(label).cast("int").alias("y_true"),
                                         positive_prob().alias("y_prob"))


def score_with(df: DataFrame, model_factory, feature_col: str, id_col: str, label_col: str | None = "label") -> DataFrame:
    """Batch scoring with a user's own model (``model_factory() → callable(list of vectors) → probs``),
    loaded once per partition by ``mapInPandas``."""
    keep = [id_col] + ([label_col] if label_col else [])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields) + \
        ", y_prob double"

    def run(batches):
        model = model_factory()
        for pdf in batches:
            out = pdf[keep].copy()
            out["y_prob"] = list(model(list(pdf[feature_col])))
            yield out

    return df.select(*keep, feature_col).mapInPandas(run, schema)


def linear_probe(emb: DataFrame, train_split: str = "a", eval_split: str = "c", emb_col: str = "embedding",
                 label: str = "label", split_col: str = "split", threshold: float | None = None) -> DataFrame:
    """M4 (+ M5 with ``threshold``): L2 logistic regression (C = 1) on labelled embeddings of the train
    split, evaluated on the eval split: AUROC, AUPRC, n_train, n_eval (+ confusion metrics at threshold)."""
    data = emb.where(F.col(label).isNotNull()).select(
        split_col, array_to_vector(F.transform(emb_col, lambda x: x.cast("double"))).alias("features"),
        F.col(label).cast("double").alias("label"))
    tr = data.where(F.col(split_col) == train_split)
    n_train = tr.count()
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=1.0 / max(n_train, 1),
                            elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-8)
    scored = lr.fit(tr).transform(data.where(F.col(split_col) == eval_split)).select(
        "label", positive_prob().alias("y_prob"))
    m = metrics.ranking_metrics(scored, "y_prob", "label").select(
        "auroc", "auprc", F.lit(n_train).alias("n_train"), (F.col("n_pos") + F.col("n_neg")).alias("n_eval"))
    if threshold is None:
        return m
    hard = scored.select("label", (F.col("y_prob") >= threshold).cast("int").alias("pred"))
    conf = metrics.binary_metrics(hard, "pred", "label").drop("auroc", "auprc")
    c = conf.first().asDict()
    for k, v in c.items():
        m = m.withColumn(k, F.lit(v))
    return m


def label_scarcity(emb: DataFrame, engineered: DataFrame, feature_cols: list[str], budgets=(100, 500, 1000), id_col: str = "id",
                   seed: int = 42, emb_col: str = "embedding", label: str = "label", split_col: str = "split",
                   parallelism: int = 8, grid=GBT_GRID) -> DataFrame:
    """For each label budget (P2 draw of train ids, plus ``full``) a linear probe on the embeddings and
    the boosted sweep on the engineered features of the same ids, of which the config with the best validation
    (AUPRC, then AUROC, then the first) counts: ``(n_labelled, model, cfg_idx, val_auroc, val_auprc, test_auroc,
    test_auprc)``. A budget that takes all ids is the ``full`` draw and shares its fits. The boosted configs of all
    budgets grow in the same passes over the data; one grouped metrics pass scores everything."""
    from hourglass.operators.features import scale_pos_weight
    from hourglass.operators.sampling import budget_subsets

    lab = emb.where(F.col(label).isNotNull())
    width = _width(lab, emb_col)
    probe = lab.select(id_col, split_col, label, *[F.col(emb_col)[i].cast("double").alias(f"e{i}") for i in range(width)])
    vectors = reuse(assemble(probe, [f"e{i}" for i in range(width)], label).select(id_col, split_col, "features", label))
    table = reuse(engineered.where(F.col(label).isNotNull()).select(
        id_col, split_col, F.col(label).cast("double").alias(label), *feature_cols))
    ids = vectors.where(F.col(split_col) == "a").select(id_col)
    n_ids = ids.distinct().count()
    drawn = [b for b in budgets if b < n_ids]
    names = ["full", *[str(n) for n in drawn]]
    subsets = reuse(budget_subsets(ids, id_col, tuple(drawn), seed))

    # linear probes: one fit per budget
    ests, inputs = [], []
    for b in names:
        tr = vectors.where(F.col(split_col) == "a").join(subsets.where(F.col("budget") == b).select(id_col), id_col, "left_semi")
        ests.append(make_estimator("lr", {"C": 1.0}, tr.count()))
        inputs.append(with_weights(tr, label, None))
    scored = None
    for b, f in zip(names, fit_many(ests, inputs, parallelism), strict=True):
        s = f.transform(vectors.where(F.col(split_col).isin("b", "c"))).select(
            F.lit(b).alias("n_labelled"), F.lit("lr").alias("model"), F.lit(0).alias("cfg_idx"), split_col, label,
            positive_prob().alias("y_prob"))
        scored = s if scored is None else scored.unionByName(s)

    # boosting: every config of every budget in the same passes; a row carries one bit per budget that drew it
    bit = F.when(F.col("budget").isNull(), 0)
    for k, b in enumerate(names):
        bit = bit.when(F.col("budget") == b, 1 << k)
    members = subsets.groupBy(id_col).agg(F.sum(bit).cast("long").alias("_member"))
    train = reuse(table.where(F.col(split_col) == "a").join(members, id_col))
    configs, keys = [], []
    for k, b in enumerate(names):
        ratio = scale_pos_weight(train.where(F.col("_member").bitwiseAND(1 << k) > 0), label, "classic").first()["pos_weight"]
        for i, c in enumerate(gbt_grid(ratio, grid)):
            configs.append(booster(c, k))
            keys.append((b, i))
    fitted = boosting.fit(train, feature_cols, configs, label, id_col, "_member")
    which = table.sparkSession.createDataFrame([(j, b, i) for j, (b, i) in enumerate(keys)], "config int, n_labelled string, cfg_idx int")
    boosted = fitted.score(table.where(F.col(split_col).isin("b", "c")), [split_col, label]).join(small_side(which), "config")
    scored = scored.unionByName(boosted.select("n_labelled", F.lit("gbt").alias("model"), "cfg_idx", split_col, label, "y_prob"))
    res = metrics.ranking_metrics(scored, "y_prob", label, ["n_labelled", "model", "cfg_idx", split_col])
    board = res.groupBy("n_labelled", "model", "cfg_idx").agg(*[
        F.max(F.when(F.col(split_col) == s, F.col(c))).alias(f"{name}_{c}") for s, name in (("b", "val"), ("c", "test"))
        for c in ("auroc", "auprc")])
    # at most one row per config and group
    best = board.groupBy("n_labelled", "model").agg(F.max_by(
        F.struct(*[c for c in board.columns if c not in ("n_labelled", "model")]),
        F.struct("val_auprc", "val_auroc", -F.col("cfg_idx"))).alias("r")).select("n_labelled", "model", "r.*")
    same = [str(n) for n in budgets if n >= n_ids]
    names = F.when(F.col("n_labelled") == "full", F.array(*[F.lit(x) for x in ["full", *same]])).otherwise(F.array("n_labelled"))
    return best.withColumn("n_labelled", F.explode(names))


def _width(df: DataFrame, emb_col: str) -> int:
    return int(df.agg(F.max(F.size(emb_col))).first()[0])
