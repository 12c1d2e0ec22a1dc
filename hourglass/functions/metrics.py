"""Exact, tie-aware evaluation metrics as aggregations.

AUROC and average precision are computed from per-(group, score) positive/negative counts (partial
aggregation, so a score shared by a third of all rows is one row after the map side) and running sums
along the score order (:func:`running_sums`, distributed). With ``P`` positives, ``N`` negatives and, at
each distinct score ``s``, ``pos(s)``, ``neg(s)`` and inclusive cumulative counts ``pos≤(s)``, ``neg≤(s)``::

    AUROC = Σ_s pos(s) · (neg≤(s) − ½·neg(s)) / (P·N)                         (Mann–Whitney, ties = ½)
    AP    = Σ_s pos(s)/P · TP(s) / (TP(s) + FP(s)),  TP(s), FP(s) = counts with score ≥ s

AP is the step-wise Σ (R_n − R_{n−1}) P_n over distinct thresholds (no interpolation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.cumulative import running_sums
from hourglass.session import cut_lineage


def _grouped(df: DataFrame, groups) -> tuple[DataFrame, list[str], bool]:
    """No groups = one literal group, so every combine below is an equi-join, never a cross join."""
    groups = list(groups)
    if groups:
        return df, groups, False
    return df.withColumn("_all", F.lit(1)), ["_all"], True


def ranking_metrics(df: DataFrame, score: str, label: str, groups: list[str] | tuple = ()) -> DataFrame:
    """M6 + M7 per group: ``(*groups, n_pos, n_neg, auroc, auprc)``; AUROC NULL when a class is absent,
    AUPRC NULL without positives. Rows with a NULL score or label are ignored.

    Running sums go in descending score order, so ``TP(s)``/``FP(s)`` are the cumulative counts and
    ``AUROC = Σ_s neg(s)·(TP(s) − ½·pos(s)) / (P·N)`` needs no per-row totals.
    """
    df, groups, synthetic = _grouped(df, groups)
    base = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = base.groupBy(*groups, (-F.col(score).cast("double")).alias("_neg_s")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg"))
    # one row per (group, score): the running sums read it three times, its input once
    cum = running_sums(cut_lineage(counts), groups, "_neg_s", ["pos", "neg"])
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    agg = cum.groupBy(*groups).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.col("neg") * (tp - F.lit(0.5) * F.col("pos"))).alias("_auc_num"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos") * tp / (tp + fp))).alias("_ap_num"))
    out = agg.select(*groups, "n_pos", "n_neg",
                     F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                            F.col("_auc_num") / (F.col("n_pos") * F.col("n_neg"))).alias("auroc"),
                     F.when(F.col("n_pos") > 0, F.col("_ap_num") / F.col("n_pos")).alias("auprc"))
    return out.drop("_all") if synthetic else out


def binary_metrics(df: DataFrame, pred: str, label: str, groups: list[str] | tuple = ()) -> DataFrame:
    """M8: confusion counts, precision/recall/specificity (0 on zero division), predicted class counts,
    plus M6/M7 on the hard predictions. ``label``/``pred``: 1 = positive ("dead"), 0 = negative ("alive").
    """
    df, groups, synthetic = _grouped(df, groups)
    y, p = F.col(label), F.col(pred)
    conf = df.groupBy(*groups).agg(
        F.sum(((p == 1) & (y == 1)).cast("long")).alias("tp"), F.sum(((p == 1) & (y == 0)).cast("long")).alias("fp"),
        F.sum(((p == 0) & (y == 0)).cast("long")).alias("tn"), F.sum(((p == 0) & (y == 1)).cast("long")).alias("fn"),
        F.sum((p == 1).cast("long")).alias("n_pred_pos"), F.sum((p == 0).cast("long")).alias("n_pred_neg"),
        F.count(F.lit(1)).alias("n"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(F.col(a).cast("double"), (F.col(a) + F.col(b)).cast("double")), F.lit(0.0))

    conf = conf.select("*", ratio("tp", "fp").alias("precision"), ratio("tp", "fn").alias("recall"),
                       ratio("tn", "fp").alias("specificity"))
    rank = ranking_metrics(df, pred, label, groups).drop("n_pos", "n_neg")
    out = conf.join(rank, groups, "left")
    return out.drop("_all") if synthetic else out


def scale_risk(score: str) -> F.Column:
    """M9: 1..10 answer → risk in [0, 1]."""
    return (F.col(score).cast("double") - F.lit(1.0)) / F.lit(9.0)


def scale_metrics(df: DataFrame, score: str, label: str, threshold: int = 6,
                  groups: list[str] | tuple = ()) -> DataFrame:
    """M9: ranking metrics on ``(s − 1) / 9`` and confusion metrics on ``s ≥ threshold``."""
    df, groups, synthetic = _grouped(df, groups)
    d = df.select(*groups, F.col(label), scale_risk(score).alias("_risk"),
                  (F.col(score) >= F.lit(threshold)).cast("int").alias("_hard"))
    rank = ranking_metrics(d, "_risk", label, groups).select(
        *groups, F.col("auroc").alias("risk_auroc"), F.col("auprc").alias("risk_auprc"))
    out = binary_metrics(d, "_hard", label, groups).join(rank, groups, "left")
    return out.drop("_all") if synthetic else out


def fail_as_wrong(df: DataFrame, pred: str, label: str, mode: str = "binary") -> DataFrame:
    """A failed answer (NULL) counts as wrong — binary: ``1 − label``; scale: 1 if label = 1 else 10."""
    y = F.col(label)
    fallback = (F.lit(1) - y) if mode == "binary" else F.when(y == 1, F.lit(1)).otherwise(F.lit(10))
    return df.withColumn("failed", F.col(pred).isNull()).withColumn(pred, F.coalesce(F.col(pred), fallback))


def select_best(board: DataFrame, groups: list[str] | tuple = (), auprc: str = "val_auprc",
                auroc: str = "val_auroc", order: str = "cfg_idx") -> DataFrame:
    """Best row per group by (AUPRC, AUROC); the earlier config wins exact ties (strict ``>``)."""
    w = Window.partitionBy(*groups).orderBy(F.col(auprc).desc_nulls_last(), F.col(auroc).desc_nulls_last(),
                                            F.col(order).asc())
    return board.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def leaderboard(board: DataFrame, auprc: str = "val_auprc", auroc: str = "val_auroc") -> DataFrame:
    """Sorted (AUPRC, AUROC) descending."""
    return board.orderBy(F.col(auprc).desc_nulls_last(), F.col(auroc).desc_nulls_last())


def early_stopping(history: DataFrame, patience: int, groups: list[str] | tuple = (), epoch: str = "epoch",
                   auprc: str = "auprc", auroc: str = "auroc") -> DataFrame:
    """Per run, the stop epoch (first epoch with ``patience`` epochs since the last strict improvement
    of (AUPRC, AUROC), else the last epoch) and the best epoch at or before it.
    Output ``(*groups, stop_epoch, best_epoch, best_auprc, best_auroc)``.
    """
    history, groups, synthetic = _grouped(history, groups)
    key = F.struct(F.col(auprc), F.col(auroc))
    w_prev = Window.partitionBy(*groups).orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    w_run = Window.partitionBy(*groups).orderBy(epoch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = history.withColumn("_prev_best", F.max(key).over(w_prev))
    h = h.withColumn("_improved", F.col("_prev_best").isNull() | (key > F.col("_prev_best")))
    h = h.withColumn("_last_imp", F.max(F.when(F.col("_improved"), F.col(epoch))).over(w_run))
    h = h.withColumn("_since", F.col(epoch) - F.col("_last_imp"))
    stops = h.groupBy(*groups).agg(
        F.coalesce(F.min(F.when(F.col("_since") >= patience, F.col(epoch))), F.max(epoch)).alias("stop_epoch"))
    cand = h.join(stops, groups).where(F.col(epoch) <= F.col("stop_epoch")).where("_improved")
    out = cand.groupBy(*groups).agg(
        F.first("stop_epoch").alias("stop_epoch"),
        F.max_by(F.col(epoch), F.struct(F.col(auprc), F.col(auroc), -F.col(epoch))).alias("best_epoch"),
        F.max_by(F.col(auprc), F.struct(F.col(auprc), F.col(auroc), -F.col(epoch))).alias("best_auprc"),
        F.max_by(F.col(auroc), F.struct(F.col(auprc), F.col(auroc), -F.col(epoch))).alias("best_auroc"))
    return out.drop("_all") if synthetic else out


def compare_experiments(a: DataFrame, b: DataFrame, key: str = "config_name",
                        metrics: tuple = ("auroc", "auprc"), names: tuple = ("a", "b")) -> DataFrame:
    """Inner lookup of two result tables on the config name, delta columns, sorted by ΔAUPRC desc."""
    na, nb = names
    left = a.select(key, *[F.col(m).alias(f"{na}_{m}") for m in metrics])
    right = b.select(key, *[F.col(m).alias(f"{nb}_{m}") for m in metrics])
    out = left.join(right, key, "inner")
    out = out.select("*", *[(F.col(f"{nb}_{m}") - F.col(f"{na}_{m}")).alias(f"delta_{m}") for m in metrics])
    return out.orderBy(F.col(f"delta_{metrics[-1]}").desc_nulls_last())


def split_counts(df: DataFrame, split_col: str = "split", label: str = "label") -> DataFrame:
    """Labelled and total rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_total"), F.count(F.col(label)).alias("n_labelled"))
