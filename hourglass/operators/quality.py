"""Data quality (D1–D6): checks as rows ``(check, status, detail)`` with status OK / WARN / FAIL.

All embedding checks come from one aggregation pass over the table plus a small class-count
aggregation; id agreement between an embedding table and a separate label table uses anti-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_ELEMS = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)


SHOWN_CLASSES = 50  # classes that a check's detail text names


def _row(check: str, ok, detail, warn=None):
    status = F.when(ok, F.lit("OK")).otherwise(F.lit("WARN") if warn else F.lit("FAIL"))
    return F.struct(F.lit(check).alias("check"), status.alias("status"), detail.alias("detail"))


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def embedding_checks(emb: DataFrame, emb_col: str = "embedding", label_col: str = "label",
                     k_clusters: int = 2, perplexity: int = 30) -> DataFrame:
    """D1–D5 over an embedding table with a label column:

    non-empty, uniform width (2-D), numeric elements, no non-finite element, labels castable to int,
    sample counts agree, ≥ 2 classes (else FAIL), exactly {0, 1} (else WARN), fewer classes than the
    K-Means k (WARN), K-Means feasible (n ≥ k), t-SNE feasible (n > perplexity), and a final verdict.
    """
    dt = emb.schema[emb_col].dataType
    numeric = isinstance(dt, T.ArrayType) and isinstance(dt.elementType, NUMERIC_ELEMS)
    e = F.col(emb_col)
    bad = F.size(F.filter(e, lambda x: F.isnan(x.cast("double")) | x.cast("double").isin(float("inf"), float("-inf"))))
    lab = F.col(label_col)
    a = emb.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(e)).alias("wmin"), F.max(F.size(e)).alias("wmax"),
                F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("n_bad"),
                F.count(lab).alias("n_lab"),
                F.count(lab.cast("string").try_cast("double").try_cast("int")).alias("n_castable"))
    classes = emb.select(lab.cast("string").try_cast("double").try_cast("int").alias("c")).where("c IS NOT NULL").distinct()
    c = classes.agg(F.count(F.lit(1)).alias("n_classes"), F.sum((~F.col("c").isin(0, 1)).cast("int")).alias("n_non_binary")).first()
    n_classes, non_bin = int(c["n_classes"]), int(c["n_non_binary"] or 0)
    # the detail names the first classes only; the counts cover all
    shown = [r[0] for r in classes.select(F.col("c").cast("string").alias("c")).orderBy("c").limit(SHOWN_CLASSES).collect()]
    class_list = ",".join(shown) + (",…" if n_classes > SHOWN_CLASSES else "")
    rows = [
        _row("non_empty", F.col("n") > 0, F.concat(F.lit("n="), _s("n"))),
        _row("uniform_width", (F.col("n") > 0) & (F.col("wmin") == F.col("wmax")) & (F.col("wmin") > 0),
             F.concat(F.lit("width="), _s("wmin"), F.lit(".."), _s("wmax"))),
        _row("numeric", F.lit(numeric), F.lit(dt.simpleString())),
        _row("finite", F.col("n_bad") == 0, F.concat(F.lit("non_finite="), _s("n_bad"))),
        _row("labels_castable", F.col("n_castable") == F.col("n_lab"),
             F.concat(F.lit("castable="), _s("n_castable"), F.lit(" of "), _s("n_lab"))),
        _row("count_match", F.col("n_lab") == F.col("n"), F.concat(F.lit("embeddings="), _s("n"), F.lit(" labels="),
                                                                    _s("n_lab"))),
        _row("two_classes", F.lit(n_classes >= 2), F.lit(f"classes=[{class_list}]")),
        _row("binary_labels", F.lit(n_classes == 2 and non_bin == 0), F.lit(f"classes=[{class_list}]"), warn=True),
        _row("classes_vs_k", F.lit(n_classes >= k_clusters), F.lit(f"classes={n_classes} k={k_clusters}"), warn=True),
        _row("kmeans_feasible", F.col("n") >= k_clusters, F.concat(F.lit("n="), _s("n"), F.lit(f" k={k_clusters}"))),
        _row("tsne_feasible", F.col("n") > perplexity, F.concat(F.lit("n="), _s("n"), F.lit(f" perplexity={perplexity}"))),
    ]
    checks = a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return checks


def verdict(checks: DataFrame) -> DataFrame:
    """D1 verdict: FAIL when any check failed, else OK."""
    return checks.agg(F.when(F.sum((F.col("status") == "FAIL").cast("int")) > 0, F.lit("FAIL"))
                      .otherwise(F.lit("OK")).alias("verdict"),
                      F.sum((F.col("status") == "WARN").cast("int")).cast("long").alias("n_warn"),
                      F.sum((F.col("status") == "FAIL").cast("int")).cast("long").alias("n_fail"))


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per class."""
    return df.groupBy(F.col(label_col).alias("class")).agg(F.count(F.lit(1)).alias("count"))


def id_agreement(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Ids present on one side only (anti-joins both ways): rows ``(side, n_missing)``."""
    ia, ib = a.select(id_col).distinct(), b.select(id_col).distinct()
    only_a = ia.join(ib, id_col, "left_anti").agg(F.count(F.lit(1)).alias("n_missing"))
    only_b = ib.join(ia, id_col, "left_anti").agg(F.count(F.lit(1)).alias("n_missing"))
    return only_a.select(F.lit("left_only").alias("side"), "n_missing").unionByName(
        only_b.select(F.lit("right_only").alias("side"), "n_missing"))


def panel_expectations(panel: DataFrame, spec, required: list[str] | None = None, strict: bool = False) -> DataFrame:
    """One row per (id, time) pair, every entity has n_steps rows, feature count, required columns.

    With ``strict`` a failed check raises (``raise_error``) when the result is evaluated.
    """
    required = required or [spec.id_col, spec.time_col]
    missing = [c for c in required if c not in panel.columns]
    n_feat = len([c for c in spec.features if c in panel.columns])
    per = panel.groupBy(spec.id_col).agg(F.count(F.lit(1)).alias("k"), F.countDistinct(spec.time_col).alias("kd"))
    a = per.agg(F.count(F.lit(1)).alias("ids"), F.min("k").alias("kmin"), F.max("k").alias("kmax"),
                F.sum(F.col("k") - F.col("kd")).cast("long").alias("dups"))
    rows = [
        _row("unique_id_time", F.col("dups") == 0, F.concat(F.lit("duplicates="), _s("dups"))),
        _row("fixed_length", (F.col("kmin") == spec.n_steps) & (F.col("kmax") == spec.n_steps),
             F.concat(F.lit("rows per id "), _s("kmin"), F.lit(".."), _s("kmax"), F.lit(f", expected {spec.n_steps}"))),
        _row("feature_count", F.lit(n_feat == len(spec.features)), F.lit(f"{n_feat} of {len(spec.features)}")),
        _row("required_columns", F.lit(not missing), F.lit("missing=" + ",".join(missing))),
    ]
    out = a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if strict:
        out = out.withColumn("status", F.when(F.col("status") == "FAIL", F.raise_error(
            F.concat(F.lit("expectation failed: "), F.col("check"), F.lit(" "), F.col("detail")))).otherwise(F.col("status")))
    return out


def unique_ids(features: DataFrame, id_col: str) -> DataFrame:
    """One row per entity in a feature table."""
    a = features.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(id_col).alias("nd"))
    return a.select(_row("unique_ids", F.col("n") == F.col("nd"),
                         F.concat(F.lit("rows="), _s("n"), F.lit(" ids="), _s("nd"))).alias("r")).select("r.*")
