"""Filtering, sampling and subsets.

Draws are seeded hash ranks, so they are exact-size, without replacement and identical under task
retries. Each draw of ``n`` is a distributed top-n (per-partition top-n, then a merge of n·partitions
rows), never a global window; ``n`` is the requested sample size, so broadcasting it is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.exprs import draw_rank


def labelled(df: DataFrame, label: str = "label") -> DataFrame:
    """Keep rows with a usable label (not NULL, not NaN), label cast to int."""
    y = F.col(label)
    cond = y.isNotNull()
    if dict(df.dtypes)[label] in ("double", "float"):
        cond = cond & ~F.isnan(y)
    return df.where(cond).withColumn(label, y.cast("int"))


def budget_subsets(ids: DataFrame, id_col: str, budgets=(100, 500, 1000), seed: int = 42) -> DataFrame:
    """For each budget n, min(n, N) ids drawn without replacement (independent draws per budget,
    not nested), plus ``full`` = all ids. Output ``(budget string, id)``.
    """
    ids = ids.select(id_col).distinct()
    parts = [ids.select(F.lit("full").alias("budget"), id_col)]
    for n in budgets:
        pick = ids.orderBy(draw_rank(seed, f"budget-{n}", id_col), id_col).limit(int(n))
        parts.append(pick.select(F.lit(str(n)).alias("budget"), id_col))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def subset_by_ids(df: DataFrame, ids: DataFrame, id_col: str, order_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``, in the list's order. ``order_col`` is a column of ``ids``
    that carries the list's positions; it stays in the result, so the order survives later shuffles.

    Raises naming the first 5 missing ids (a bounded ``limit(5)``) when the list has unknown ids.
    """
    missing = ids.join(df.select(id_col).distinct(), id_col, "left_anti")
    first5 = [r[0] for r in missing.orderBy(order_col or id_col).select(id_col).limit(5).collect()]
    if first5:
        raise ValueError(f"ids not found: {first5}")
    out = df.join(ids, id_col, "inner")
    return out.orderBy(order_col) if order_col else out


def stratified(df: DataFrame, label: str, n_per_class: int, classes=(1, 0), seed: int = 42,
               id_col: str = "id") -> DataFrame:
    """N rows per class in class order ``classes`` (all rows of a class when it has fewer).

    One distributed top-n per class (classes are a parameter), then a union; adds ``example_rank``.
    """
    out = None
    for k, c in enumerate(classes):
        pick = (df.where(F.col(label) == c).withColumn("_h", draw_rank(seed, "class", id_col))
                .orderBy("_h", id_col).limit(n_per_class))
        pick = pick.withColumn("class_order", F.lit(k)).drop("_h")
        out = pick if out is None else out.unionByName(pick)
    return out


def distinct_ids(df: DataFrame, id_col: str) -> DataFrame:
    """P5: distinct ids, ordered by id for determinism."""
    return df.select(id_col).distinct().orderBy(id_col)


def entity_rows(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """All rows of the given entities — one semi-join instead of a scan per entity."""
    return df.join(ids.select(id_col), id_col, "left_semi")
