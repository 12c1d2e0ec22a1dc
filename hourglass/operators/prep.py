"""Cleaning, imputation and scaling.

Fits are global aggregates over the **train** split only and return small long DataFrames
``(column, …)`` — one row per feature, so their size is bounded by the spec, never by the data. Applying
a fit reads that bounded row set once and inlines the values as literals, which keeps every transform
inside whole-stage codegen with no join against the panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.exprs import binary01, in_range, safe_log1p
from hourglass.functions.quantiles import quantile_row
from hourglass.session import reuse
from hourglass.spec import PanelSpec


def _long(row_df: DataFrame, cols: list[str], value_names: list[str]) -> DataFrame:
    """Unpivot a one-row fit ``{col}__{name}`` into ``(column, *value_names)``."""
    structs = [F.struct(F.lit(c).alias("column"),
                        *[F.col(f"`{c}__{n}`").alias(n) for n in value_names]) for c in cols]
    return row_df.select(F.explode(F.array(*structs)).alias("p")).select("p.*")


def params_dict(params: DataFrame) -> dict:
    """Bounded fit (one row per feature) → {column: {name: value}}."""
    return {r["column"]: r.asDict() for r in params.collect()}


def train_rows(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    if spec.split_col in panel.columns:
        return panel.where(F.col(spec.split_col) == spec.train_split)
    return panel


# ---------------------------------------------------------------- C1 / C2
def clean_ranges(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Out-of-range values → NULL (inclusive bounds); features absent from the panel are ignored."""
    out = panel
    for c, (low, high) in spec.ranges.items():
        if c in panel.columns:
            out = out.withColumn(c, in_range(c, low, high))
    return out


def sort_panel(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Total order by (id, time) — only for sinks; windows order themselves."""
    return panel.orderBy(spec.id_col, spec.time_col)


# ---------------------------------------------------------------- C3 / C4
def fit_fill_defaults(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Defaults for leading gaps, fitted on train rows after cleaning → ``(column, fill_value)``.

    Static binary → mode (lowest value on ties; 0.0 when empty); dynamic binary → 0.0;
    everything else → exact median (0.0 when empty; distributed, see :mod:`quantiles`). Statics count
    once per time step, like the panel.
    """
    train = train_rows(panel, spec)
    med_cols = [c for c in spec.features if c not in spec.binary]
    med = quantile_row(train, med_cols, [0.5]) if med_cols else {}
    modes = [c for c in spec.features if c in spec.binary and c in spec.static]
    mode_row = train.agg(*[F.mode(F.col(c), True).cast("double").alias(c) for c in modes]).first() if modes else {}
    rows = []
    for c in spec.features:
        if c in modes:
            v = mode_row[c]
        elif c in spec.binary:
            v = 0.0
        else:
            v = med[c][0]
        rows.append((c, 0.0 if v is None else float(v)))
    return panel.sparkSession.createDataFrame(rows, "column string, fill_value double")


def forward_fill(panel: DataFrame, spec: PanelSpec, defaults: DataFrame | dict | None = None) -> DataFrame:
    """C4: last observation carried forward per entity in time order, then defaults; binaries → {0,1}.

    All features share one window spec, so Spark plans one Exchange + one Sort + one Window node.
    Each entity has exactly n_steps rows, so the window partitions are bounded.
    """
    d = params_dict(defaults) if isinstance(defaults, DataFrame) else (defaults or {})
    w = (Window.partitionBy(spec.id_col).orderBy(spec.time_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    exprs = []
    for c in panel.columns:
        if c in spec.features:
            e = F.last(c, ignorenulls=True).over(w)
            if c in d:
                e = F.coalesce(e, F.lit(float(d[c]["fill_value"])))
            if c in spec.binary:
                e = binary01(e)
            exprs.append(e.alias(c))
        else:
            exprs.append(F.col(c))
    return panel.select(*exprs)


# ---------------------------------------------------------------- C5 / C6
def coerce_binary(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Binary columns → round-half-even then clip to {0, 1}."""
    return panel.select(*[binary01(c).alias(c) if c in spec.binary else F.col(c) for c in panel.columns])


def log1p_columns(panel: DataFrame, cols) -> DataFrame:
    """log1p(max(x, 0)) on the given columns; NULL stays NULL; absent columns ignored."""
    cols = set(cols)
    return panel.select(*[safe_log1p(c).alias(c) if c in cols else F.col(c) for c in panel.columns])


# ---------------------------------------------------------------- C7 / C8
def fit_robust_scaler(panel: DataFrame, cols, method: str = "exact", accuracy: int = 100000) -> DataFrame:
    """Per column median and IQR (linear-interpolated quantiles); IQR NULL or 0 → 1.0.

    ``method='exact'``: distributed exact quantiles (equal to pandas; no single-task value buffer);
    ``method='approx'``: ``percentile_approx`` sketches with bounded memory.
    """
    cols = [c for c in cols if c in panel.columns]
    spark = panel.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, median double, iqr double")
    if method == "exact":
        q = quantile_row(panel, cols, [0.25, 0.5, 0.75])
    else:
        r = panel.agg(*[F.percentile_approx(F.col(c), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
                        .alias(c) for c in cols]).first()
        q = {c: (list(r[c]) if r[c] is not None else [None, None, None]) for c in cols}
    rows = []
    for c in cols:
        q1, med, q3 = q[c]
        iqr = None if q1 is None or q3 is None else float(q3) - float(q1)
        rows.append((c, None if med is None else float(med), 1.0 if iqr is None or iqr == 0 else iqr))
    return spark.createDataFrame(rows, "column string, median double, iqr double")


def apply_robust_scaler(panel: DataFrame, params: DataFrame | dict) -> DataFrame:
    """``(x - median) / iqr`` for every column that has parameters."""
    p = params_dict(params) if isinstance(params, DataFrame) else params
    out = []
    for c in panel.columns:
        if c in p:
            med, iqr = p[c]["median"], p[c]["iqr"]
            med = 0.0 if med is None else float(med)
            out.append(((F.col(c) - F.lit(med)) / F.lit(float(iqr))).alias(c))
        else:
            out.append(F.col(c))
    return panel.select(*out)


# ---------------------------------------------------------------- C9 / C10
def linear_transform(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """C5 then C6 — the stateless half of the linear-ready pipeline."""
    return log1p_columns(coerce_binary(panel, spec), spec.log)


def fit_linear(ffilled: DataFrame, spec: PanelSpec, method: str = "exact") -> DataFrame:
    """C9 fit: robust scaler on the log-transformed **train** panel, non-binary features only."""
    return fit_robust_scaler(train_rows(linear_transform(ffilled, spec), spec), spec.scaled, method)


def make_linear(ffilled: DataFrame, spec: PanelSpec, params: DataFrame | dict) -> DataFrame:
    """C9 apply: same transform on any split with the train parameters."""
    return apply_robust_scaler(linear_transform(ffilled, spec), params)


def process_splits(grid: DataFrame, spec: PanelSpec, method: str = "exact"):
    """Clean every split; fit defaults + scaler on train only; ffill + linear-ready all splits.

    Returns ``(ffill, linear, defaults, scaler)``. The two fits are the only driver round trips,
    each one row per feature.
    """
    clean = reuse(clean_ranges(grid, spec))
    defaults = fit_fill_defaults(clean, spec)
    ffill = forward_fill(clean, spec, params_dict(defaults))
    scaler = fit_linear(ffill, spec, method)
    linear = make_linear(ffill, spec, params_dict(scaler))
    return ffill, linear, defaults, scaler


# ---------------------------------------------------------------- C11–C13
def fit_standard_scaler(df: DataFrame, cols) -> DataFrame:
    """C11 fit: mean and population std; zero (or NULL) std → 1.0."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    long = _long(df.agg(*aggs), list(cols), ["mean", "std"])
    return long.withColumn("std", F.when(F.col("std").isNull() | (F.col("std") == 0), F.lit(1.0))
                           .otherwise(F.col("std")))


def apply_standard_scaler(df: DataFrame, params: DataFrame | dict) -> DataFrame:
    p = params_dict(params) if isinstance(params, DataFrame) else params
    return df.select(*[((F.col(c) - F.lit(float(p[c]["mean"] or 0.0))) / F.lit(float(p[c]["std"]))).alias(c)
                       if c in p else F.col(c) for c in df.columns])


def normalize_static(df: DataFrame, params: DataFrame | dict, cols) -> DataFrame:
    """``(x - median) / (iqr + 1e-8)`` where the column has parameters, raw otherwise."""
    p = params_dict(params) if isinstance(params, DataFrame) else params
    cols = set(cols)
    return df.select(*[((F.col(c) - F.lit(float(p[c]["median"]))) / F.lit(float(p[c]["iqr"]) + 1e-8)).alias(c)
                       if c in cols and c in p else F.col(c) for c in df.columns])
