"""Exact quantiles without a single-task buffer.

``percentile`` over a global group merges a value→count map of every distinct value in ONE final task;
at 100 TB that map is the column. Here the same exact answer (linear interpolation between order
statistics, as numpy/pandas and DuckDB ``quantile_cont``) is computed as:

1. ``(group, column, value) → count`` (partial aggregation; a value held by a third of all rows is one row),
2. running counts along the value order per (group, column) — range-partitioned, distributed,
3. per (group, column): rank position ``h = q·(n−1)``; the order statistics at ``floor(h)`` and
   ``ceil(h)`` are the smallest values whose inclusive running count exceeds those ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.cumulative import running_sums
from hourglass.session import small_side


def value_counts_long(df: DataFrame, cols: list[str], groups: list[str] | tuple = ()) -> DataFrame:
    """Non-null values of each column as ``(*groups, column, value, n)``."""
    groups = list(groups)
    long = df.select(*groups, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                                  for c in cols])).alias("kv")).select(*groups, "kv.*")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy(*groups, "column", "value") \
        .agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], groups: list[str] | tuple = (),
                    counts: DataFrame | None = None) -> DataFrame:
    """``(*groups, column, q_0, q_1, …)`` — one column per requested probability (NULL when no values).

    ``counts``: precomputed :func:`value_counts_long` of ``df`` (e.g. persisted by the caller)."""
    groups = list(groups)
    vc = counts if counts is not None else value_counts_long(df, cols, groups)
    keys = groups + ["column"]
    cum = running_sums(vc, keys, "value", ["n"])
    tot = cum.groupBy(*keys).agg(F.sum("n").alias("_tot"))
    j = cum.join(small_side(tot), keys)  # one row per (group, column): broadcast behind the size check
    aggs = []
    for i, q in enumerate(probs):
        h = F.lit(float(q)) * (F.col("_tot") - 1)
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.min(F.when(F.col("cum_n") > lo, F.col("value"))).alias(f"_lo{i}"),
                 F.min(F.when(F.col("cum_n") > hi, F.col("value"))).alias(f"_hi{i}"),
                 F.first(h - lo).alias(f"_fr{i}")]
    a = j.groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for i in range(len(probs)):
        lo, hi, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        out.append((lo + (hi - lo) * fr).alias(f"q_{i}"))
    return a.select(*out)


def quantile_row(df: DataFrame, cols: list[str], probs: list[float]) -> dict:
    """Global exact quantiles as ``{column: [q…]}`` (bounded: one row per column). Columns without
    values map to NULLs. The counts are kept (memory, then disk) while the running counts read them.
    """
    from pyspark import StorageLevel

    res = {c: [None] * len(probs) for c in cols}
    vc = value_counts_long(df, cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for r in exact_quantiles(df, cols, probs, counts=vc).collect():
            res[r["column"]] = [r[f"q_{i}"] for i in range(len(probs))]
    finally:
        vc.unpersist()
    return res
