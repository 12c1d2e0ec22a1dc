"""Measurement tokens (T1–T8): the cleaned, un-imputed panel re-expressed as one row per observed value.

Tokenising is a per-row generator (``explode`` of an array of structs) — no shuffle. Scaling parameters
are a bounded one-row-per-feature fit inlined as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.exprs import binary01, safe_log1p
from hourglass.operators.prep import fit_robust_scaler, log1p_columns, params_dict, train_rows
from hourglass.spec import PanelSpec


def fit_value_scaler(clean: DataFrame, spec: PanelSpec, method: str = "exact") -> DataFrame:
    """Per feature ``(column, is_binary, use_log1p, median, iqr)`` over OBSERVED train values.

    Binary → (0, 1); log features are log1p'd first; an empty feature → (0, 1); IQR 0 or NULL → 1.
    Statics repeat on every step and are weighted accordingly, as in the panel.
    """
    train = train_rows(clean, spec)
    non_bin = [c for c in spec.features if c not in spec.binary]
    fit = fit_robust_scaler(log1p_columns(train, spec.log), non_bin, method)
    fit = fit.select("column", F.lit(False).alias("is_binary"),
                     F.col("column").isin(list(spec.log)).alias("use_log1p"),
                     F.coalesce("median", F.lit(0.0)).alias("median"), "iqr")
    spark = clean.sparkSession
    if spec.binary:
        b = spark.createDataFrame([(c, True, False, 0.0, 1.0) for c in spec.binary],
                                  "column string, is_binary boolean, use_log1p boolean, median double, iqr double")
        fit = fit.unionByName(b)
    return fit


def transform_value(c: str, p: dict):
    """NULL stays NULL; binary → clip(round half even); else optional log1p(max(x, 0)), then robust scale."""
    if p["is_binary"]:
        return binary01(c)
    x = safe_log1p(c) if p["use_log1p"] else F.col(c)
    return (x - F.lit(float(p["median"]))) / F.lit(float(p["iqr"]))


def tokenise(clean: DataFrame, spec: PanelSpec, params: DataFrame | dict, one_hot: bool = True) -> DataFrame:
    """One token per observed cell; statics only at step 0; ``t_scaled = step / (n_steps - 1)``.

    Output ``(id, t_scaled, value_scaled, label, var_idx[, var_<feature> …])``; the label rides along
    (NULL when the entity is unlabelled instead of failing).
    """
    p = params_dict(params) if isinstance(params, DataFrame) else params
    t = F.col(spec.time_col)
    cells = []
    for i, c in enumerate(spec.features):
        keep = F.col(c).isNotNull()
        if c in spec.static:
            keep = keep & (t == 0)
        cells.append(F.when(keep, F.struct(F.lit(i).alias("var_idx"), transform_value(c, p[c]).alias("v"))))
    label = [F.col(spec.target_col)] if spec.target_col in clean.columns else [F.lit(None).cast("int").alias(spec.target_col)]
    extra = [F.col(spec.split_col)] if spec.split_col in clean.columns else []
    tok = (clean.select(F.col(spec.id_col), (t.cast("double") / F.lit(float(spec.n_steps - 1))).alias("t_scaled"),
                        *label, *extra, F.explode(F.filter(F.array(*cells), lambda s: s.isNotNull())).alias("tok"))
           .select(spec.id_col, "t_scaled", F.col("tok.v").alias("value_scaled"), spec.target_col,
                   F.col("tok.var_idx").alias("var_idx"), *extra))
    if one_hot:
        tok = with_one_hot(tok, spec)
    return tok


def with_one_hot(tokens: DataFrame, spec: PanelSpec) -> DataFrame:
    """T4: ``var_<feature>`` int 0/1 columns derived from the compact ``var_idx``."""
    return tokens.select("*", *[(F.col("var_idx") == i).cast("int").alias(f"var_{c}")
                                for i, c in enumerate(spec.features)])


def non_empty(tokens: DataFrame) -> DataFrame:
    """Expectation row — fails (``ok = false``) when no token was produced."""
    return tokens.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("tokens_non_empty").alias("check"), (F.col("n") > 0).alias("ok"),
        F.format_string("%d tokens", "n").alias("detail"))


def token_counts(tokens: DataFrame, spec: PanelSpec) -> DataFrame:
    """Tokens per entity; entities without tokens are absent."""
    return tokens.groupBy(spec.id_col).agg(F.count(F.lit(1)).alias("n_tokens"))


def token_summary(tokens: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per split: tokens, entities, average tokens per entity, min/max t_scaled."""
    keys = [spec.split_col] if spec.split_col in tokens.columns else []
    return tokens.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_tokens"), F.countDistinct(spec.id_col).alias("n_entities"),
        (F.count(F.lit(1)) / F.countDistinct(spec.id_col)).alias("avg_tokens"),
        F.min("t_scaled").alias("min_t"), F.max("t_scaled").alias("max_t"))
