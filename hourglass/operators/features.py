"""Entity-level features (F1–F5): one ``groupBy(id)`` with expressions generated from the spec.

Partial aggregation runs map-side for every expression (min_by/max_by/avg/stddev/regr_slope are all
declarative aggregates), so an entity that holds a third of all panel rows is combined before the
shuffle and the final task only merges small buffers.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.exprs import finite_or_zero
from hourglass.spec import PanelSpec

STATS = ("first", "last", "mean", "min", "max", "std", "delta", "slope")


def last_state(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """last NON-NULL value per feature (pandas ``GroupBy.last`` semantics), label from the first row."""
    t = F.col(spec.time_col)
    aggs = [F.max_by(c, F.when(F.col(c).isNotNull(), t)).alias(c) for c in spec.features if c in panel.columns]
    if spec.target_col in panel.columns:
        aggs.append(F.min_by(spec.target_col, t).alias(spec.target_col))
    return panel.groupBy(spec.id_col).agg(*aggs)


def _dyn_stats(c: str, t) -> list:
    first = F.min_by(c, t)
    last = F.max_by(c, t)
    return [first.alias(f"{c}_first"), last.alias(f"{c}_last"), F.avg(c).alias(f"{c}_mean"),
            F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.stddev_pop(c).alias(f"{c}_std"),
            (last - first).alias(f"{c}_delta"),
            F.coalesce(F.regr_slope(F.col(c), t.cast("double")), F.lit(0.0)).alias(f"{c}_slope")]


def engineered(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """F2 + F3: statics (first row) + 8 statistics per dynamic feature, label from the first row,
    then C13 (NULL/NaN/±inf → 0). Slope is least squares over non-missing points, 0.0 when degenerate.
    """
    t = F.col(spec.time_col)
    aggs = [F.min_by(c, t).alias(c) for c in spec.static]
    for c in spec.dynamic:
        aggs += _dyn_stats(c, t)
    has_label = spec.target_col in panel.columns
    if has_label:
        aggs.append(F.min_by(spec.target_col, t).alias(spec.target_col))
    out = panel.groupBy(spec.id_col).agg(*aggs)
    feats = feature_names(spec)
    return out.select(spec.id_col, *[finite_or_zero(c).alias(c) for c in feats],
                      *([spec.target_col] if has_label else []))


def feature_names(spec: PanelSpec) -> list[str]:
    return list(spec.static) + [f"{c}_{s}" for c in spec.dynamic for s in STATS]


def scale_pos_weight(df: DataFrame, label_col: str = "label", zero_pos: str = "classic") -> DataFrame:
    """n_neg / n_pos. With no positives: 1.0 (``classic``) or n_neg / 1 (``deep``)."""
    y = F.col(label_col)
    n_pos = F.sum((y == 1).cast("long"))
    n_neg = F.sum((y == 0).cast("long"))
    fallback = F.lit(1.0) if zero_pos == "classic" else n_neg.cast("double")
    return df.agg(n_pos.alias("n_pos"), n_neg.alias("n_neg"),
                  F.when(n_pos > 0, n_neg / n_pos).otherwise(fallback).alias("pos_weight"))


def assemble(df: DataFrame, feature_cols: list[str], label_col: str = "label",
             out_col: str = "features") -> DataFrame:
    """X/y projection as an ML vector column plus a double label."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=out_col, handleInvalid="keep")
    return va.transform(df).withColumn(label_col, F.col(label_col).cast("double"))
