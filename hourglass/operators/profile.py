"""Profiling / exploratory statistics (E1–E9): the tables behind each exploratory plot.

Wide statistics come from one aggregation pass. Exact distinct counts are computed from a long
``(column, value)`` projection with partial aggregation (dedup map-side) rather than one COUNT DISTINCT
per column, which Spark would plan as an Expand multiplying every row by the number of columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.session import small_side
from hourglass.functions.quantiles import exact_quantiles, quantile_row

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType, T.ByteType)


def column_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column ``dtype, non_null, missing, missing_pct, n_unique, min, q25, median, q75, max, mean,
    std`` (sample std); numeric statistics NULL for non-numeric columns.
    """
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    n = F.count(F.lit(1))
    aggs = [n.alias("_n")]
    for f in fields:
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"{f.name}__nn"))
        if isinstance(f.dataType, NUMERIC):
            x = c.cast("double")
            aggs += [F.min(x).alias(f"{f.name}__min"), F.max(x).alias(f"{f.name}__max"),
                     F.avg(x).alias(f"{f.name}__mean"), F.stddev_samp(x).alias(f"{f.name}__std")]
    wide = df.agg(*aggs)
    num_cols = [f.name for f in fields if isinstance(f.dataType, NUMERIC)]
    qs = quantile_row(df, num_cols, [0.25, 0.5, 0.75]) if num_cols else {}
    for c in num_cols:
        wide = wide.withColumn(f"{c}__q", F.array(*[F.lit(v).cast("double") for v in qs[c]]))
    structs = []
    for f in fields:
        num = isinstance(f.dataType, NUMERIC)
        nn = F.col(f"`{f.name}__nn`")

        def g(s, num=num, name=f.name):
            return F.col(f"`{name}__{s}`") if num else F.lit(None).cast("double")

        q = g("q")
        structs.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
            nn.alias("non_null"), (F.col("_n") - nn).alias("missing"),
            ((F.col("_n") - nn) / F.col("_n") * F.lit(100.0)).alias("missing_pct"),
            g("min").alias("min"), (q[0] if num else q).alias("q25"), (q[1] if num else q).alias("median"),
            (q[2] if num else q).alias("q75"), g("max").alias("max"), g("mean").alias("mean"), g("std").alias("std")))
    stats = wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
    longv = df.select(F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"),
                                                   F.col(f"`{f.name}`").cast("string").alias("v"))
                                          for f in fields])).alias("kv")).select("kv.*")
    uniq = longv.where(F.col("v").isNotNull()).distinct().groupBy("column") \
        .agg(F.count(F.lit(1)).alias("n_unique"))
    out = stats.join(uniq, "column", "left").withColumn("n_unique", F.coalesce("n_unique", F.lit(0)).cast("long"))
    return out.select("column", "dtype", "non_null", "missing", "missing_pct", "n_unique", "min", "q25", "median",
                      "q75", "max", "mean", "std").orderBy(F.col("missing_pct").desc(), "column")


def missingness(profile: DataFrame) -> DataFrame:
    """Missingness ranking, ascending."""
    return profile.select("column", "missing_pct").orderBy("missing_pct", "column")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value including missing, by value with missing last."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.col("value").asc_nulls_last())


def histogram(df: DataFrame, col: str, bins: int = 40, log10: bool = False) -> DataFrame:
    """Equal-width histogram over [min, max] with the last bin closed, all bins listed (zeros too).

    ``log10=True`` keeps positive values only and bins ``log10(x)``. min = max widens to ±0.5.
    All-missing input gives no rows. The range is a one-row fit inlined as literals.
    """
    x = F.col(col).cast("double")
    v = (df.where(x > 0).select(F.log10(x).alias("x")) if log10 else df.select(x.alias("x"))) \
        .where(F.col("x").isNotNull())
    r = v.agg(F.min("x").alias("mn"), F.max("x").alias("mx")).first()
    spark = df.sparkSession
    if r is None or r["mn"] is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    lo, hi = (r["mn"] - 0.5, r["mx"] + 0.5) if r["mn"] == r["mx"] else (r["mn"], r["mx"])
    width = (hi - lo) / bins
    idx = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    counts = v.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def box_stats(df: DataFrame, col: str, whis: float = 1.5) -> DataFrame:
    """q1, median, q3, whiskers (furthest datum within whis·IQR of the box) and outlier count.

    Two passes: the quartiles (one row, inlined), then conditional min/max/count.
    """
    x = F.col(col).cast("double")
    q = quantile_row(df, [col], [0.25, 0.5, 0.75])[col]
    if q[0] is None:
        return df.sparkSession.createDataFrame([], "q1 double, median double, q3 double, whisker_low double, "
                                                   "whisker_high double, n_outliers long")
    q1, med, q3 = q
    lo, hi = q1 - whis * (q3 - q1), q3 + whis * (q3 - q1)
    v = df.select(x.alias("x")).where(F.col("x").isNotNull())
    return v.agg(F.lit(q1).alias("q1"), F.lit(med).alias("median"), F.lit(q3).alias("q3"),
                 F.min(F.when(F.col("x") >= lo, F.col("x"))).alias("whisker_low"),
                 F.max(F.when(F.col("x") <= hi, F.col("x"))).alias("whisker_high"),
                 F.sum(((F.col("x") < lo) | (F.col("x") > hi)).cast("long")).alias("n_outliers"))


def time_profile(df: DataFrame, col: str, time_col: str) -> DataFrame:
    """Per time step mean, median, q25, q75 and non-missing count."""
    x = F.col(col).cast("double")
    basic = df.groupBy(time_col).agg(F.avg(x).alias("mean"), F.count(x).alias("n_obs"))
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], [time_col]).select(
        time_col, F.col("q_1").alias("median"), F.col("q_0").alias("q25"), F.col("q_2").alias("q75"))
    return basic.join(q, time_col, "left").select(time_col, "mean", "median", "q25", "q75", "n_obs")


def random_trajectories(df: DataFrame, col: str, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of min(n, available) entities having at least one observed value of ``col``, drawn
    without replacement by a seeded hash rank (distributed top-n, ``n`` is the requested sample size).
    """
    from hourglass.functions.exprs import draw_rank

    ids = df.where(F.col(col).isNotNull()).select(id_col).distinct()
    chosen = ids.orderBy(draw_rank(seed, "trajectory", id_col), id_col).limit(n)
    return df.join(small_side(chosen), id_col, "left_semi")


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns and the column listing."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"), F.lit(", ".join(df.columns)).alias("columns"))
