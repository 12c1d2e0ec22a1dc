"""Column expressions shared by the operators. All are built-in Spark expressions (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clock_minutes(text) -> Column:
    """G2: 'HH:MM' (HH may exceed 23) → minutes; malformed text → NULL."""
    parts = F.split(col(text), ":")
    h = parts.getItem(0).try_cast("bigint")
    m = parts.getItem(1).try_cast("bigint")
    return h * 60 + m


def ceil_bin(elapsed, width: int) -> Column:
    """Causal ceiling bin; 0 → 0, (0, w] → 1, (w, 2w] → 2, …"""
    return F.ceil(col(elapsed) / F.lit(float(width))).cast("bigint")


def binary01(c) -> Column:
    """Round half to even, then clip to [0, 1]; NULL stays NULL."""
    return F.least(F.greatest(F.bround(col(c), 0), F.lit(0.0)), F.lit(1.0))


def safe_log1p(c) -> Column:
    """log1p(max(x, 0)) with NULL kept (bare greatest(NULL, 0) would give 0)."""
    c = col(c)
    return F.when(c.isNotNull(), F.log1p(F.greatest(c, F.lit(0.0))))


# Texts that mean a missing number in a log (they are written cells, unlike other words).
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                 "NULL", "NaN", "None", "n/a", "nan", "null")


def log_number(text) -> Column:
    """A log's value: a double, NaN for a missing number, NULL for other text."""
    text = col(text)
    return F.when(text.isin(*MISSING_TEXTS), F.lit(float("nan"))).otherwise(text.try_cast("double"))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def finite_or_zero(c) -> Column:
    """NULL, NaN, ±inf → 0."""
    c = col(c)
    bad = c.isNull() | F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def in_range(c, low, high) -> Column:
    """Keep values inside the inclusive [low, high]; either bound may be None."""
    c = col(c)
    cond = F.lit(True)
    if low is not None:
        cond = cond & (c >= F.lit(float(low)))
    if high is not None:
        cond = cond & (c <= F.lit(float(high)))
    return F.when(cond, c)


def draw_rank(seed: int, draw: str, *cols) -> Column:
    """Rank key of a seeded draw: the first 60 bits of ``md5(seed|draw|id…)`` as a bigint.

    Independent between seeds and draws, defined for ids of any type and size, the same in every retry
    (unlike ``rand()``), and DuckDB reproduces it exactly.
    """
    text = F.concat_ws("|", F.lit(str(int(seed))), F.lit(draw), *[col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def md5_unit(seed: int, tag: str, *cols) -> Column:
    """Uniform double in (0, 1] from 52 bits of ``md5(seed|tag|cols…)``: seeded, the same in every retry, and
    reproducible in DuckDB."""
    text = F.concat_ws("|", F.lit(str(int(seed))), F.lit(tag), *[col(c).cast("string") for c in cols])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return (bits + F.lit(1)).cast("double") / F.lit(float((1 << 52) + 1))
