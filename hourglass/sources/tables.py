"""Bindings of the driver tables onto the panel abstractions (S4 scans + the EAV contract).

* ``events``   → EAV log: id = user_id, parameter = event_type, value = value, time = ts (daily causal
  bins from 2024-01-01 00:00, 31 steps), file order = event_id. Values below 1 are the sentinel.
* ``customer`` → static attributes per user (c_custkey = user_id).
* label        → derived per user from ``events`` (total error value above a constant); users of the
  HOUSEHOLD segment have no outcome row, so the panel has unlabelled entities.
* split        → ``user_id % 4``: 0, 1 → a (train), 2 → b (validation), 3 → c (test).
* ``lineitem`` → a larger EAV log: id = l_suppkey, 4 numeric measures, 28-day bins from 1995-01-01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.spec import PanelSpec

# Fixed values of the bindings (constants of the test schema).
EVENTS_ORIGIN = "2024-01-01 00:00:00"
DAY_US = 86_400_000_000
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
LABEL_ERROR_TOTAL = 640.0
UNLABELLED_SEGMENT = "HOUSEHOLD"
LINEITEM_ORIGIN = "1995-01-01 00:00:00"
LINEITEM_WIDTH_US = 28 * DAY_US
LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def elapsed_us(ts_col: str, origin: str):
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{origin}', {ts_col})")


EVENTS_SPEC = PanelSpec(
    id_col="user_id", time_col="day", target_col="label",
    static=("acctbal", "building", "nation"),
    dynamic=EVENT_TYPES,
    binary=("building",),
    log=("purchase", "view"),
    ranges={"click": (2, 200), "error": (2, 200), "purchase": (2, 200), "signup": (2, 200),
            "view": (2, 200), "acctbal": (0, None)},
    n_steps=31, sentinel=-1.0,
)

LINEITEM_SPEC = PanelSpec(
    id_col="l_suppkey", time_col="period", target_col="label",
    static=(), dynamic=LINEITEM_MEASURES, binary=(), log=("l_extendedprice",),
    ranges={"l_quantity": (1, 50), "l_discount": (0, 0.1)}, n_steps=92, sentinel=None,
)


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → canonical EAV ``(id, elapsed, parameter, value, ord)``; sentinel encoded as -1."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("id"), elapsed_us("ts", EVENTS_ORIGIN).alias("elapsed"),
                     F.col("event_type").alias("parameter"),
                     F.when(F.col("value") < 1, F.lit(-1.0)).otherwise(F.col("value")).alias("value"),
                     F.col("event_id").alias("ord"))


def events_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label): 1 when the user's total error value exceeds the constant; no row for unlabelled users."""
    ev = table(spark, sf_dir, "events")
    tot = ev.groupBy(F.col("user_id").alias("id")).agg(
        F.coalesce(F.sum(F.when(F.col("event_type") == "error", F.col("value"))), F.lit(0.0)).alias("err"))
    seg = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != UNLABELLED_SEGMENT) \
        .select(F.col("c_custkey").alias("id"))
    return tot.join(seg, "id", "left_semi").select(
        "id", (F.col("err") > F.lit(LABEL_ERROR_TOTAL)).cast("int").alias("label"))


def split_of(id_col) -> F.Column:
    m = F.pmod(F.col(id_col), F.lit(4))
    return F.when(m <= 1, F.lit("a")).when(m == 2, F.lit("b")).otherwise(F.lit("c"))


def with_split(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    return panel.withColumn(spec.split_col, split_of(spec.id_col))


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem → EAV with one row per (line, measure); order = (orderkey, linenumber)."""
    li = table(spark, sf_dir, "lineitem")
    ord_ = F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("parameter"), F.col(m).alias("value"))
                                  for m in LINEITEM_MEASURES])).alias("kv")
    return li.select(F.col("l_suppkey").alias("id"), elapsed_us("l_shipdate", LINEITEM_ORIGIN).alias("elapsed"),
                     ord_.alias("ord"), stacked).select("id", "elapsed", "kv.parameter", "kv.value", "ord")


def events_entities(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """Every user of ``events`` with statics and (optionally) the derived label, from ONE per-user
    aggregation of the log plus one id-granularity join with ``customer`` — the log is
    not scanned twice."""
    from hourglass.session import small_side

    ev = table(spark, sf_dir, "events")
    per = ev.groupBy(F.col("user_id").alias("id")).agg(
        F.coalesce(F.sum(F.when(F.col("event_type") == "error", F.col("value"))), F.lit(0.0)).alias("_err"))
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"),
        (F.col("c_mktsegment") == "BUILDING").cast("double").alias("building"),
        F.col("c_nationkey").cast("double").alias("nation"), F.col("c_mktsegment").alias("_seg"))
    j = per.join(small_side(c), "id", "left")
    cols = ["id", "acctbal", "building", "nation"]
    if labelled:
        lab = F.when(F.col("_seg").isNotNull() & (F.col("_seg") != UNLABELLED_SEGMENT),
                     (F.col("_err") > F.lit(LABEL_ERROR_TOTAL)).cast("int"))
        return j.select(*cols, lab.alias(EVENTS_SPEC.target_col))
    return j.select(*cols)
