"""Distributed running sums within groups along a numeric order key.

``Window.partitionBy(g).orderBy(k)`` puts a whole group in one task; for metric tables with one or a
few groups that is one task for everything. Here every row gets a deterministic *bucket* — the slot of
its key among approximate quantile boundaries of the order key (boundaries computed once and
inlined as Bucketizer splits, so any recomputation, e.g. after an executor loss, assigns the same bucket). Each
(bucket, group) slice gets a local running sum, and a table with one row per (bucket, group) supplies
the offset of everything before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.session import small_side


def with_bucket(df: DataFrame, order_col: str, n_buckets: int, out_col: str = "_bk") -> DataFrame:
    """Adds the bucket of each row: approximate quantile boundaries of the order key (one sketch pass,
    ``n_buckets`` − 1 values inlined as splits), located by binary search (``Bucketizer``)."""
    from pyspark.ml.feature import Bucketizer

    n = max(1, int(n_buckets))
    probs = [i / n for i in range(1, n)]
    row = df.agg(F.percentile_approx(F.col(order_col).cast("double"), probs, 10000).alias("b")).first() if probs else None
    bounds = sorted(set(float(x) for x in ((row["b"] if row else None) or [])))
    if not bounds:
        return df.withColumn(out_col, F.lit(0.0))
    key = f"{out_col}_key"
    splits = [float("-inf")] + bounds + [float("inf")]
    # a key equal to a boundary belongs to the bucket that starts there (splits are left-closed)
    out = Bucketizer(splits=splits, inputCol=key, outputCol=out_col, handleInvalid="keep").transform(
        df.withColumn(key, F.col(order_col).cast("double")))
    return out.drop(key)


def running_sums(df: DataFrame, groups: list[str], order_col: str, cols: list[str],
                 prefix: str = "cum_", buckets: int | None = None) -> DataFrame:
    """Adds ``{prefix}{c}`` = Σ c over rows of the same group with order ≤ this row (inclusive).

    The order key must be numeric and unique within a group (aggregate ties first). The bucket count
    follows the shuffle partitions, so it grows with the cluster's setting for the data.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    b = with_bucket(df, order_col, n)
    w_local = (Window.partitionBy("_bk", *groups).orderBy(order_col)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(c).over(w_local).alias(f"_loc_{c}") for c in cols])
    tot = b.groupBy("_bk", *groups).agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    w_off = Window.partitionBy(*groups).orderBy("_bk") if groups else Window.orderBy("_bk")
    # one row per (bucket, group): bounded by buckets × groups
    offs = tot.select("_bk", *groups, *[(F.sum(f"_t_{c}").over(w_off) - F.col(f"_t_{c}")).alias(f"_off_{c}")
                                        for c in cols])
    out = local.join(small_side(offs), ["_bk", *groups])
    return out.select(*[c for c in df.columns],
                      *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{prefix}{c}") for c in cols])
