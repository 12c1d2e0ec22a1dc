"""Evaluation plans over the bound tables (M6–M18): score tables, leaderboards and training histories.

* Scores: ``documents`` text statistics are the candidate "models" (configs), ``labels.quality`` /
  ``labels.toxic`` the truth, ``doc_id % 4`` the split (0, 1 → a; 2 → b (validation); 3 → c (test)).
* History: for every day of the events panel (epoch = day + 1), the ranking quality of that day's
  forward-filled ``error`` value against the user label on the validation split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions import metrics
from hourglass.sources import tables

# Fixed configs: (cfg_idx, config_name, score expression)
CONFIGS = (
    (0, "n_chars", "CAST(n_chars AS DOUBLE)"),
    (1, "neg_n_chars", "-CAST(n_chars AS DOUBLE)"),
    (2, "n_lines", "CAST(size(split(text, '\\n')) AS DOUBLE)"),
    (3, "n_digits", "CAST(length(regexp_replace(text, '[^0-9]', '')) AS DOUBLE)"),
)


def doc_split():
    m = F.pmod(F.col("doc_id"), F.lit(4))
    return F.when(m <= 1, "a").when(m == 2, "b").otherwise("c")


def scored_documents(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """``(doc_id, split, cfg_idx, config_name, score, label)`` — one row per document and config."""
    docs = tables.table(spark, sf_dir, "documents")
    labs = tables.table(spark, sf_dir, "labels").select("doc_id", F.col(target).alias("label"))
    j = docs.join(labs, "doc_id", "inner")
    cfg = F.explode(F.array(*[F.struct(F.lit(i).alias("cfg_idx"), F.lit(n).alias("config_name"),
                                       F.expr(e).alias("score")) for i, n, e in CONFIGS])).alias("c")
    return j.select("doc_id", doc_split().alias("split"), "label", cfg).select(
        "doc_id", "split", "c.cfg_idx", "c.config_name", "c.score", "label")


def config_board(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """Leaderboard rows ``(cfg_idx, config_name, val_auroc, val_auprc, test_auroc, test_auprc)``."""
    s = scored_documents(spark, sf_dir, target).where(F.col("split").isin("b", "c"))
    m = metrics.ranking_metrics(s, "score", "label", ["cfg_idx", "config_name", "split"])
    return m.groupBy("cfg_idx", "config_name").agg(
        F.max(F.when(F.col("split") == "b", F.col("auroc"))).alias("val_auroc"),
        F.max(F.when(F.col("split") == "b", F.col("auprc"))).alias("val_auprc"),
        F.max(F.when(F.col("split") == "c", F.col("auroc"))).alias("test_auroc"),
        F.max(F.when(F.col("split") == "c", F.col("auprc"))).alias("test_auprc"))


def history(spark: SparkSession, sf_dir: str, feature: str = "error") -> DataFrame:
    """Per-epoch validation metrics ``(epoch, auroc, auprc)`` of a panel feature (see module doc)."""
    from hourglass.plans import panel

    ff = panel.events_ffill(spark, sf_dir).where(F.col("split") == "b")
    m = metrics.ranking_metrics(ff, feature, "label", ["day"])
    return m.select((F.col("day") + 1).alias("epoch"), "auroc", "auprc")


def hard_predictions(spark: SparkSession, sf_dir: str, cutoff: int = 1500) -> DataFrame:
    """Binary answers: predicted positive when a document is longer than ``cutoff`` characters."""
    docs = tables.table(spark, sf_dir, "documents")
    labs = tables.table(spark, sf_dir, "labels")
    return docs.join(labs, "doc_id").select("doc_id", "lang", (F.col("n_chars") > cutoff).cast("int").alias("pred"),
                                            F.col("quality").alias("label"))


def scale_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1..10 answers: ``least(10, 1 + floor(n_chars / 1000))``."""
    docs = tables.table(spark, sf_dir, "documents")
    labs = tables.table(spark, sf_dir, "labels")
    s = F.least(F.lit(10), F.lit(1) + F.floor(F.col("n_chars") / 1000).cast("int"))
    return docs.join(labs, "doc_id").select("doc_id", s.alias("score"), F.col("quality").alias("label"))


# ------------------------------------------------------------------ prompts over the events panel
def events_prompt_spec():
    from hourglass.operators.prompts import PromptSpec

    return PromptSpec(static_lines=(("acctbal", "number", "Account balance", 2, "", None),
                                    ("building", "binary", "Segment", None, "", ("Building", "Other")),
                                    ("nation", "number", "Nation", 0, "", None)),
                      flag_lines=())


def events_blocks(spark: SparkSession, sf_dir: str, split: str = "c") -> DataFrame:
    from hourglass.operators.prompts import patient_blocks
    from hourglass.plans import panel
    from hourglass.sources.tables import EVENTS_SPEC

    clean = panel.events_clean(spark, sf_dir).where(F.col("split") == split)
    return patient_blocks(clean, EVENTS_SPEC, events_prompt_spec())


def events_examples(spark: SparkSession, sf_dir: str, mode: str = "binary") -> DataFrame:
    from hourglass.operators.prompts import few_shot_examples

    b = events_blocks(spark, sf_dir, "a").where(F.col("label").isNotNull())
    return few_shot_examples(b, "label", 3, 42, mode, "user_id")


def events_answers(spark: SparkSession, sf_dir: str, mode: str = "binary", shots: str = "zero") -> DataFrame:
    from hourglass.operators import prompts

    b = events_blocks(spark, sf_dir, "c").where(F.col("label").isNotNull())
    if shots == "zero":
        p = prompts.zero_shot_prompt(b, mode)
    else:
        ex = events_examples(spark, sf_dir, mode).first()["examples"]
        p = prompts.few_shot_prompt(b, ex, mode)
    return prompts.call_model(p, prompts.rule_client_factory(mode), "user_id", "label", 3, mode)
