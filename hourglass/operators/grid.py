"""Grid construction: EAV measurement log → dense causal panel.

Canonical log schema (what every source produces)::

    id bigint, elapsed bigint (units since the entity's origin), parameter string,
    value string|double, ord bigint (file order; the later row wins)

Plan shape (``build_grid``): one aggregation per entity for statics/labels (at id granularity), an
``explode(sequence)`` spine, and ONE ``groupBy(id, time)`` over spine ∪ binned log. The binned log is
pre-aggregated map-side, so an entity holding a third of all rows collapses to ≤ n_steps cells
before the shuffle. No join is made against the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.exprs import ceil_bin, log_number, nan_to_null
from hourglass.session import small_side
from hourglass.spec import PanelSpec


def keep_dynamic(log: DataFrame, spec: PanelSpec) -> DataFrame:
    """G1: only parameters that are dynamic features enter the dynamic stream."""
    return log.where(F.col("parameter").isin(list(spec.dynamic)))


def bin_log(log: DataFrame, spec: PanelSpec, width: int) -> DataFrame:
    """G1 + G3 + G4 + G5 + G6 → (id, time, parameter, value double, ord).

    Non-numeric values are skipped (``try_cast``), sentinel rows are dropped *before* last-write-wins,
    and bins outside [0, n_steps) are discarded. A missing number (NaN) stays until last-write-wins, so
    it blanks an earlier value of its cell.
    """
    v = log_number("value") if dict(log.dtypes)["value"] == "string" else F.col("value").cast("double")
    out = (keep_dynamic(log, spec)
           .where(F.col("elapsed") >= 0)
           .select("id", ceil_bin("elapsed", width).alias(spec.time_col), "parameter",
                   v.alias("value"), "ord")
           .where(F.col(spec.time_col) <= spec.n_steps - 1)
           .where(F.col("value").isNotNull()))
    if spec.sentinel is not None:
        out = out.where(F.col("value") != F.lit(float(spec.sentinel)))
    return out


def last_write_cells(binned: DataFrame, spec: PanelSpec) -> list:
    """G7 + G9: per dynamic feature, the value of the latest row (by ``ord``) in the group; NaN → NULL."""
    return [nan_to_null(F.max_by("value", F.when(F.col("parameter") == f, F.col("ord")))).alias(f)
            for f in spec.dynamic]


def static_from_log(log: DataFrame, static_map: dict, sentinel: float | None = -1.0) -> DataFrame:
    """Per id, the FIRST row (file order) at elapsed == 0 for each static parameter; sentinel → NULL.

    ``static_map`` maps output column → log parameter (e.g. ``Weight_static`` → ``Weight``).
    """
    num = log_number(F.col("value").cast("string"))
    aggs = []
    for out_col, param in static_map.items():
        v = F.min_by(num, F.when((F.col("parameter") == param) & (F.col("elapsed") == 0), F.col("ord")))
        if sentinel is not None:
            v = F.when(v != F.lit(float(sentinel)), v)
        aggs.append(nan_to_null(v).alias(out_col))
    if not aggs:
        return log.select("id").distinct()
    return log.groupBy("id").agg(*aggs)


def spine(entities: DataFrame, spec: PanelSpec) -> DataFrame:
    """Exactly n_steps rows per entity (a generator, not a join)."""
    steps = F.sequence(F.lit(0).cast("bigint"), F.lit(spec.n_steps - 1).cast("bigint"))
    return entities.withColumn(spec.time_col, F.explode(steps))


def attach(entities: DataFrame, table: DataFrame | None, how: str = "left") -> DataFrame:
    """Id-granularity lookup; broadcast only when the lookup side is checked small."""
    if table is None:
        return entities
    return entities.join(small_side(table), on="id", how=how)


def build_grid(log: DataFrame, spec: PanelSpec, width: int, static_map: dict | None = None,
               statics: DataFrame | None = None, labels: DataFrame | None = None,
               entities: DataFrame | None = None) -> DataFrame:
    """EAV log → panel ``(id_col, time_col, *static, *dynamic[, target_col])``.

    * ``static_map``: statics read from the log at elapsed 0 (G10).
    * ``statics``: ``(id, *static)`` dimension table joined at id granularity (G11).
    * ``labels``: ``(id, label)``; unmatched ids get NULL (G13). Without labels there is no target column.
    * ``entities``: a precomputed per-entity table ``(id, [statics…], [target])`` covering every id of the
      log (e.g. ids, statics and labels from one aggregation); replaces the three above.
    """
    if entities is None:
        entities = static_from_log(log, static_map or {}, spec.sentinel)
        entities = attach(entities, statics)
        if labels is not None:
            entities = attach(entities, labels.select("id", F.col(labels.columns[1]).alias(spec.target_col)))
    ent_cols = [c for c in entities.columns if c != "id"]
    sp = spine(entities, spec)

    binned = bin_log(log, spec, width)
    rows = sp.unionByName(binned, allowMissingColumns=True)
    aggs = [F.max(c).alias(c) for c in ent_cols] + last_write_cells(rows, spec)
    grid = rows.groupBy("id", spec.time_col).agg(*aggs)
    cols = [F.col("id").alias(spec.id_col), F.col(spec.time_col)]
    cols += [(F.col(c) if c in grid.columns else F.lit(None)).cast("double").alias(c) for c in spec.static]
    cols += [F.col(c).cast("double").alias(c) for c in spec.dynamic]
    if spec.target_col in ent_cols:
        cols.append(F.col(spec.target_col))
    return grid.select(*cols)


def union_splits(parts: dict[str, DataFrame], spec: PanelSpec) -> DataFrame:
    """Union per-split panels into one DataFrame with a split column."""
    out = None
    for name, df in parts.items():
        d = df.withColumn(spec.split_col, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def grid_invariants(grid: DataFrame, spec: PanelSpec) -> DataFrame:
    """Expectation rows ``(check, ok, detail)``; one aggregation pass."""
    n_feat = len([c for c in grid.columns if c in spec.features])
    s = grid.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(spec.id_col).alias("ids"))
    return s.select(F.explode(F.array(
        F.struct(F.lit("feature_columns").alias("check"),
                 F.lit(n_feat == len(spec.features)).alias("ok"),
                 F.lit(f"{n_feat} of {len(spec.features)}").alias("detail")),
        F.struct(F.lit("rows_per_entity").alias("check"),
                 (F.col("rows") == F.col("ids") * spec.n_steps).alias("ok"),
                 F.format_string("rows=%d ids=%d steps=%d", "rows", "ids", F.lit(spec.n_steps)).alias("detail")),
    )).alias("c")).select("c.*")


def grid_summary(grid: DataFrame, spec: PanelSpec) -> DataFrame:
    """Entities, rows, labelled entities and missing-cell rate over all feature cells."""
    feats = [c for c in spec.features if c in grid.columns]
    nulls = sum((F.col(c).isNull().cast("long") for c in feats), F.lit(0).cast("long"))
    aggs = [F.countDistinct(spec.id_col).alias("n_entities"), F.count(F.lit(1)).alias("n_rows"),
            F.sum(nulls).alias("missing_cells")]
    if spec.target_col in grid.columns:
        aggs.append(F.countDistinct(F.when(F.col(spec.target_col).isNotNull(), F.col(spec.id_col)))
                    .alias("n_labelled"))
    out = grid.agg(*aggs)
    return out.withColumn("missing_rate",
                          F.col("missing_cells") / (F.col("n_rows") * F.lit(len(feats))).cast("double"))
