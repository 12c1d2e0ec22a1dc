"""Consecutive 0-based row positions in a total order, without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task. The position of a row is the
number of rows with a smaller key: a distributed running count (:func:`running_sums`) over a unique
numeric key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.cumulative import running_sums
from hourglass.session import small_side


def global_index(df: DataFrame, order_cols: list[str], out_col: str = "pos") -> DataFrame:
    """Position by a unique numeric key (``order_cols`` of length 1), 0-based and consecutive."""
    if len(order_cols) != 1:
        raise ValueError("global_index orders by one unique numeric key; build a composite key first")
    key = order_cols[0]
    # only the key goes through the running counts; whole rows meet their position by one equi-join
    one = df.select(key, F.lit(1).cast("long").alias("_one"))
    place = running_sums(one, [], key, ["_one"], prefix="_cum").select(key, (F.col("_cum_one") - 1).cast("bigint").alias(out_col))
    return df.join(place, key)


def file_order_key(df: DataFrame, file_col: str = "_f", row_col: str = "_r", out_col: str = "_key") -> DataFrame:
    """Unique numeric key for (file name, row index within file): file rank · 2^40 + row index.

    The ranks come from a distributed sort of the distinct file names and meet the rows by a join.
    """
    names = df.select(file_col).distinct().orderBy(file_col)
    ranked = names.rdd.zipWithIndex().map(lambda x: (x[0][0], x[1]))
    ranks = df.sparkSession.createDataFrame(ranked, f"{file_col} string, _rank long")
    key = F.col("_rank") * F.lit(1 << 40) + F.col(row_col).cast("bigint")
    return df.join(small_side(ranks), file_col).withColumn(out_col, key).drop("_rank")
