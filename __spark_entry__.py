"""

Every query reads the driver tables under ``sf_dir`` (or data Spark derives from them) in full. Double
columns are rounded to 6 places at the end of each query, and the DuckDB SQL does the same.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracles as O  # noqa: E402
from hourglass.functions import metrics
from hourglass.operators import (features, grid, prep, profile, prompts, quality, sampling, sequences, tokens,
                                 vectors)
from hourglass.plans import evaluation, models, panel, roundtrip
from hourglass.sources import tables
from hourglass.session import configure
from hourglass.sources.tables import EVENTS_SPEC

SPEC = EVENTS_SPEC


def _round(c, dt):
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.round(c.cast("double"), 6)
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.DoubleType, T.FloatType, T.ArrayType)):
        return F.transform(c, lambda x: _round(x, dt.elementType))
    return c


def r6(df: DataFrame) -> DataFrame:
    """Round every double (also inside arrays) to 6 places — the precision shared with the oracle."""
    return df.select(*[_round(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return r6(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


# ------------------------------------------------------------------ panel construction and prep
def q_events_grid(spark, sf):
    return panel.events_grid(spark, sf)


def q_events_clean(spark, sf):
    return panel.events_clean(spark, sf)


def q_fill_defaults(spark, sf):
    return prep.fit_fill_defaults(panel.events_clean(spark, sf), SPEC)


def q_events_ffill(spark, sf):
    return panel.events_ffill(spark, sf)


def q_linear_panel(spark, sf):
    return panel.events_processed(spark, sf)[1]


def q_scaler_params(spark, sf):
    return panel.events_processed(spark, sf)[3]


def q_last_state(spark, sf):
    return features.last_state(panel.events_clean(spark, sf), SPEC)


def q_engineered_features(spark, sf):
    return panel.events_features(spark, sf)


def q_grid_summary(spark, sf):
    return grid.grid_summary(panel.events_grid(spark, sf), SPEC)


# ------------------------------------------------------------------ tokens
def q_token_params(spark, sf):
    return panel.events_token_params(spark, sf)


def q_tokens(spark, sf):
    return panel.events_tokens(spark, sf)


def q_token_counts(spark, sf):
    return tokens.token_counts(panel.events_tokens(spark, sf, one_hot=False), SPEC)


def q_token_summary(spark, sf):
    return tokens.token_summary(panel.events_tokens(spark, sf, one_hot=False), SPEC)


# ------------------------------------------------------------------ sequences
def q_fixed_sequences(spark, sf):
    return sequences.fixed_sequences(q_linear_panel(spark, sf), SPEC)


def q_token_sequences(spark, sf):
    return sequences.token_sequences(panel.events_tokens(spark, sf, one_hot=False), SPEC)


def q_mask_delta(spark, sf):
    return sequences.mask_delta(panel.events_clean(spark, sf), SPEC)


def q_pool(spark, sf):
    return sequences.pool(q_linear_panel(spark, sf), SPEC)


def q_static_row(spark, sf):
    return sequences.static_row(panel.events_ffill(spark, sf), SPEC)


def q_variable_series(spark, sf):
    return sequences.variable_series(panel.events_ffill(spark, sf), SPEC)


def q_length_stats(spark, sf):
    seqs = sequences.token_sequences(panel.events_tokens(spark, sf, one_hot=False), SPEC)
    from hourglass.sources.tables import with_split
    return sequences.length_stats(with_split(seqs, SPEC), "split")


def q_pad_batches(spark, sf):
    seqs = sequences.token_sequences(panel.events_tokens(spark, sf, one_hot=False), SPEC)
    return sequences.pad_batches(seqs, SPEC, 16)


# ------------------------------------------------------------------ metrics
def q_ranking_metrics(spark, sf):
    d = tables.table(spark, sf, "documents").join(tables.table(spark, sf, "labels"), "doc_id")
    return metrics.ranking_metrics(d.select("lang", F.col("n_chars").cast("double").alias("score"),
                                            F.col("quality").alias("label")), "score", "label", ["lang"])


def q_binary_metrics(spark, sf):
    return metrics.binary_metrics(evaluation.hard_predictions(spark, sf), "pred", "label", ["lang"])


def q_scale_metrics(spark, sf):
    return metrics.scale_metrics(evaluation.scale_answers(spark, sf), "score", "label", 6)


def q_leaderboard(spark, sf):
    return metrics.leaderboard(evaluation.config_board(spark, sf))


def q_select_best(spark, sf):
    return metrics.select_best(evaluation.config_board(spark, sf))


def q_compare(spark, sf):
    def test(target):
        return evaluation.config_board(spark, sf, target).select(
            "config_name", F.col("test_auroc").alias("auroc"), F.col("test_auprc").alias("auprc"))
    return metrics.compare_experiments(test("quality"), test("toxic"))


def q_history(spark, sf):
    return evaluation.history(spark, sf)


def q_early_stopping(spark, sf):
    return metrics.early_stopping(evaluation.history(spark, sf), patience=3)


def q_split_counts(spark, sf):
    g = panel.events_grid(spark, sf).select("user_id", "split", "label").distinct()
    return metrics.split_counts(g)


# ------------------------------------------------------------------ profile (train rows of the clean grid)
def _train(spark, sf):
    return panel.events_clean(spark, sf).where(F.col("split") == "a")


def q_column_profile(spark, sf):
    return profile.column_profile(_train(spark, sf).drop("split"))


def q_value_counts(spark, sf):
    return profile.value_counts(_train(spark, sf), "building")


def q_histogram(spark, sf):
    return profile.histogram(_train(spark, sf), "view", 40)


def q_log_histogram(spark, sf):
    return profile.histogram(_train(spark, sf), "purchase", 40, log10=True)


def q_box_stats(spark, sf):
    return profile.box_stats(_train(spark, sf), "click")


def q_time_profile(spark, sf):
    return profile.time_profile(_train(spark, sf), "error", "day")


def q_random_trajectories(spark, sf):
    return profile.random_trajectories(_train(spark, sf), "signup", "user_id", 10, seed=42)


def q_shape(spark, sf):
    return profile.shape(_train(spark, sf))


# ------------------------------------------------------------------ sampling
def q_labelled_features(spark, sf):
    return sampling.labelled(panel.events_features(spark, sf), "label")


def q_budget_subsets(spark, sf):
    return sampling.budget_subsets(tables.table(spark, sf, "documents"), "doc_id", (100, 500, 1000), seed=42)


def q_stratified(spark, sf):
    return sampling.stratified(tables.table(spark, sf, "labels"), "quality", 3, (1, 0), seed=42, id_col="doc_id")


def q_distinct_ids(spark, sf):
    return sampling.distinct_ids(tables.table(spark, sf, "events"), "user_id")


# ------------------------------------------------------------------ vectors
def _emb(spark, sf):
    return tables.table(spark, sf, "embeddings")


def q_l2_normalize(spark, sf):
    return _emb(spark, sf).select("vec_id", vectors.l2_normalize("embedding").alias("embedding"), "label")


def q_extract_embeddings(spark, sf):
    return vectors.extract_embeddings(q_fixed_sequences(spark, sf), "user_id", "seq", "label")


def q_channel_mean(spark, sf):
    ch = panel.events_channels(spark, sf)
    st = sequences.static_row(panel.events_ffill(spark, sf), SPEC)
    return vectors.channel_mean(ch, "user_id", statics=st, static_cols=list(SPEC.static))


def q_channel_weighted(spark, sf):
    return vectors.channel_weighted(panel.events_channels(spark, sf), "user_id", O.CHANNEL_WEIGHTS)


def q_silhouette(spark, sf):
    return vectors.silhouette(_emb(spark, sf), "embedding", "label")


def q_davies_bouldin(spark, sf):
    return vectors.davies_bouldin(_emb(spark, sf), "embedding", "label")


def _sign_cluster():
    e = F.col("embedding")
    return (e[0] > 0).cast("int") + F.lit(2) * (e[1] > 0).cast("int")


def q_contingency(spark, sf):
    return vectors.contingency_scores(_emb(spark, sf).select("label", _sign_cluster().alias("cluster")),
                                      "label", "cluster")


def q_random_projection(spark, sf):
    return vectors.random_projection(_emb(spark, sf), 64, seed=42).select("vec_id", "label", "projection")


def _views(spark, sf):
    e = vectors.as_double_array("embedding")
    v = _emb(spark, sf).select("vec_id", "label", vectors.l2_normalize(F.slice(e, 1, 32)).alias("z1"),
                               vectors.l2_normalize(F.slice(e, 33, 32)).alias("z2"))
    return vectors.assign_batches(v, "vec_id", 64)


def q_contrastive_batches(spark, sf):
    return vectors.batch_statistics(_views(spark, sf), "z1", "z2", tau=0.1)


def q_contrastive_dataset(spark, sf):
    return vectors.dataset_contrastive(vectors.batch_statistics(_views(spark, sf), "z1", "z2", tau=0.1))


def q_kmeans_report(spark, sf):
    """V5 + V13: clustering report against the binary label (label < 5), K-Means k = 2 with 10 restarts."""
    e = _emb(spark, sf).withColumn("binary", (F.col("label") < 5).cast("int"))
    return vectors.clustering_report(e, "embedding", "binary", k=2, n_init=10, seed=42)


def q_pca(spark, sf):
    return vectors.pca_2d(_emb(spark, sf), "embedding", 2).select("vec_id", "label", "projection")


# ------------------------------------------------------------------ larger panel (lineitem)
def q_lineitem_features(spark, sf):
    return panel.lineitem_features(spark, sf)


# ------------------------------------------------------------------ prompts and answers
def q_patient_blocks(spark, sf):
    return evaluation.events_blocks(spark, sf, "c")


def q_zero_shot_prompts(spark, sf):
    return prompts.zero_shot_prompt(evaluation.events_blocks(spark, sf, "c"), "binary")


def q_few_shot_examples(spark, sf):
    return evaluation.events_examples(spark, sf, "binary")


def q_few_shot_prompts(spark, sf):
    ex = evaluation.events_examples(spark, sf, "scale").first()["examples"]
    return prompts.few_shot_prompt(evaluation.events_blocks(spark, sf, "c"), ex, "scale")


def q_model_answers(spark, sf):
    return evaluation.events_answers(spark, sf, "binary", "zero")


def q_llm_eval_binary(spark, sf):
    return prompts.evaluate_answers(evaluation.events_answers(spark, sf, "binary", "few"), "label", "binary")


def q_llm_eval_scale(spark, sf):
    return prompts.evaluate_answers(evaluation.events_answers(spark, sf, "scale", "zero"), "label", "scale")


# ------------------------------------------------------------------ data quality
def q_embedding_checks(spark, sf):
    return quality.embedding_checks(_emb(spark, sf), "embedding", "label")


def q_embedding_verdict(spark, sf):
    return quality.verdict(quality.embedding_checks(_emb(spark, sf), "embedding", "label"))


def q_class_counts(spark, sf):
    return quality.class_counts(_emb(spark, sf), "label")


def q_id_agreement(spark, sf):
    return quality.id_agreement(tables.table(spark, sf, "documents"), tables.table(spark, sf, "labels"), "doc_id")


def q_panel_expectations(spark, sf):
    return quality.panel_expectations(panel.events_grid(spark, sf), SPEC)


def q_grid_invariants(spark, sf):
    return grid.grid_invariants(panel.events_grid(spark, sf), SPEC)


def q_unique_ids(spark, sf):
    return quality.unique_ids(panel.events_features(spark, sf), "user_id")


# ------------------------------------------------------------------ sources and sinks (round trips)
def q_raw_log_grid(spark, sf):
    return roundtrip.raw_log_grid(spark, sf)


def q_raw_log_rejects(spark, sf):
    return roundtrip.raw_log_rejects(spark, sf)


def q_embedding_manifest(spark, sf):
    return roundtrip.embedding_store_manifest(spark, sf)


def q_positional_embeddings(spark, sf):
    return roundtrip.positional_embeddings(spark, sf)


def q_params_roundtrip(spark, sf):
    return roundtrip.params_roundtrip(spark, sf)


def q_panel_roundtrip(spark, sf):
    return roundtrip.panel_roundtrip(spark, sf)


# ------------------------------------------------------------------ models (Spark ML; rows-only checks)
def q_lr_sweep(spark, sf):
    return models.sweep(panel.events_last_state(spark, sf, True), list(SPEC.features), "lr", models.LR_GRID, "user_id")


def q_rf_sweep(spark, sf):
    return models.sweep(panel.events_last_state(spark, sf, False), list(SPEC.features), "rf", models.RF_GRID, "user_id")


def q_gbt_sweep(spark, sf):
    t = panel.events_last_state(spark, sf, False)
    pw = features.scale_pos_weight(t.where("split = 'a'"), "label", "classic").first()["pos_weight"]
    return models.sweep(t, list(SPEC.features), "gbt", models.gbt_grid(pw), "user_id")


def q_lr_engineered(spark, sf):
    """M1 on F2 + C11: engineered features standardised with train mean / population std."""
    f = panel.events_features(spark, sf)
    names = features.feature_names(SPEC)
    params = prep.fit_standard_scaler(f.where("split = 'a'"), names)
    return models.sweep(prep.apply_standard_scaler(f, params), names, "lr", models.LR_GRID, "user_id")


def q_pos_weight(spark, sf):
    return features.scale_pos_weight(panel.events_last_state(spark, sf, False).where("split = 'a'"), "label")


def _emb_split(spark, sf):
    e = _emb(spark, sf)
    m = F.pmod(F.col("vec_id"), F.lit(4))
    return e.select(F.col("vec_id").alias("id"), F.when(m <= 1, "a").when(m == 2, "b").otherwise("c").alias("split"),
                    "embedding", (F.col("label") < 5).cast("int").alias("label"))


def q_linear_probe(spark, sf):
    return models.linear_probe(_emb_split(spark, sf), "a", "c")


def q_probe_threshold(spark, sf):
    return models.linear_probe(_emb_split(spark, sf), "a", "c", threshold=0.5)


def q_label_scarcity(spark, sf):
    """The recency embeddings and the engineered features of the same users; the boosted member is
    chosen among all eight configs in every budget."""
    f = panel.events_features(spark, sf)
    emb = vectors.extract_embeddings(q_fixed_sequences(spark, sf), "user_id", "seq", "label")
    emb = emb.join(f.select("user_id", "split"), "user_id")
    return models.label_scarcity(emb, f, features.feature_names(SPEC), (100, 500, 1000), "user_id")


def q_gbt_engineered(spark, sf):
    """M3 on F2: the boosted sweep on the engineered features."""
    f = panel.events_features(spark, sf)
    pw = features.scale_pos_weight(f.where("split = 'a'"), "label", "classic").first()["pos_weight"]
    return models.sweep(f, features.feature_names(SPEC), "gbt", models.gbt_grid(pw), "user_id")


def q_rf_engineered(spark, sf):
    """M2 on F2: the forest sweep on the engineered features."""
    return models.sweep(panel.events_features(spark, sf), features.feature_names(SPEC), "rf", models.RF_ENGINEERED_GRID, "user_id")


def q_experiment_grid(spark, sf):
    """All experiments with the number of labelled users per split."""
    return models.experiment_grid(panel.events_grid(spark, sf), len(SPEC.features), "user_id")


def q_predictions(spark, sf):
    return models.predictions(panel.events_last_state(spark, sf, True), list(SPEC.features), "lr",
                              models.LR_GRID[2], "user_id")


# ------------------------------------------------------------------ remaining single operators
def q_standard_scaled(spark, sf):
    """C11: engineered features standardised with train mean / population std (zero std → 1)."""
    f = panel.events_features(spark, sf)
    names = features.feature_names(SPEC)
    return prep.apply_standard_scaler(f, prep.fit_standard_scaler(f.where("split = 'a'"), names))


def q_static_normalize(spark, sf):
    """Statics of the forward-filled panel normalised with the train scaler (x − median) / (iqr + 1e-8)."""
    _, _, _, scaler = panel.events_processed(spark, sf)
    st = sequences.static_row(panel.events_ffill(spark, sf), SPEC)
    return prep.normalize_static(st, scaler, list(SPEC.static))


def q_missingness(spark, sf):
    return profile.missingness(profile.column_profile(_train(spark, sf).drop("split")))


def q_subset_ids(spark, sf):
    """Documents restricted to the 100-id budget draw (all ids exist, so no error)."""
    docs = tables.table(spark, sf, "documents")
    ids = sampling.budget_subsets(docs, "doc_id", (100,), seed=42).where("budget = '100'").select("doc_id")
    # the list's order: by descending id
    ids = ids.withColumn("position", -F.col("doc_id"))
    return sampling.subset_by_ids(docs.select("doc_id", "lang", "source", "n_chars"), ids, "doc_id", "position")


def q_masked_mean(spark, sf):
    seqs = sequences.token_sequences(panel.events_tokens(spark, sf, one_hot=False), SPEC)
    return sequences.masked_mean(sequences.pad_batches(seqs, SPEC, 16)).select("user_id", "pooled")


def q_tokens_non_empty(spark, sf):
    return tokens.non_empty(panel.events_tokens(spark, sf, one_hot=False))


def q_positions(spark, sf):
    """Q8: sinusoidal positions added to the fixed sequences (table length = n_steps)."""
    return sequences.add_positions(q_fixed_sequences(spark, sf), SPEC.n_steps).select("user_id", "seq")


def q_augment(spark, sf):
    """Q9: two independent augmented views (crop 16 of 31 days, noise 0.05, channel drop 0.1)."""
    seqs = q_fixed_sequences(spark, sf)
    v0 = sequences.augment(seqs, SPEC, seed=42, view=0, crop_len=16)
    return sequences.augment(v0, SPEC, seed=42, view=1, crop_len=16).select("user_id", "view0", "view1")


def q_summary_json(spark, sf):
    """The per-config leaderboard as JSON documents (non-finite → null)."""
    from hourglass.sources import sinks
    return sinks.summary_json(r6(evaluation.config_board(spark, sf)))


def q_score_with(spark, sf):
    """Batch scoring of the last-state features with a user's own (numpy) model."""
    import numpy as np

    def factory():
        w = np.linspace(-1.0, 1.0, len(SPEC.features))

        def model(rows):
            x = np.asarray([np.asarray(r, dtype=float) for r in rows])
            return (1.0 / (1.0 + np.exp(-(np.nan_to_num(x) @ w) / 100.0))).tolist()
        return model

    t = panel.events_last_state(spark, sf, True)
    t = t.select("user_id", "label", F.array(*[F.col(c).cast("double") for c in SPEC.features]).alias("x"))
    return models.score_with(t, factory, "x", "user_id", "label")


def q_side_by_side(spark, sf):
    """Embedding, label and sign-pattern cluster written side by side by id, read back."""
    from hourglass.sources import sinks
    e = _emb(spark, sf)
    path = roundtrip.scratch(spark, "side-by-side")
    sinks.write_side_by_side([e.select(F.col("vec_id").alias("id"), "embedding"),
                              e.select(F.col("vec_id").alias("id"), "label"),
                              e.select(F.col("vec_id").alias("id"), _sign_cluster().alias("cluster"))], path)
    return spark.read.parquet(path)


def q_concat_features(spark, sf):
    """Q4: scaled panel ‖ observation mask ‖ time since last observation, one array per (user, day),
    computed under one window from the cleaned panel (train-fitted defaults and scaler)."""
    from hourglass.session import reuse
    clean = reuse(panel.events_clean(spark, sf))
    defaults = prep.params_dict(prep.fit_fill_defaults(clean, SPEC))
    scaler = prep.params_dict(prep.fit_linear(prep.forward_fill(clean, SPEC, defaults), SPEC))
    return sequences.concat_one_pass(clean, SPEC, defaults, scaler)


def q_results_roundtrip(spark, sf):
    """The leaderboard written as CSV with header and read back with its schema."""
    from hourglass.sources import sinks
    board = evaluation.config_board(spark, sf)
    path = roundtrip.scratch(spark, "leaderboard-csv")
    sinks.write_results(board, path)
    return spark.read.option("header", "true").schema(board.schema).csv(path)


def q_outcomes_scan(spark, sf):
    """The outcomes written as CSV with further columns and scanned back as ``(id, label)``."""
    from hourglass.sources import logs
    out = tables.events_outcomes(spark, sf)
    path = roundtrip.scratch(spark, "outcomes")
    out.select(F.col("id").alias("RecordID"), F.lit(1).alias("SAPS-I"), F.col(out.columns[1]).alias("In-hospital_death")) \
        .write.option("header", "true").csv(path)
    return logs.scan_outcomes(spark, path)


def q_variable_map(spark, sf):
    """S7 + S14: the panel's variable map, written, read back and joined with the observed cells of each variable."""
    from hourglass.sources import sinks
    from hourglass.spec import feature_catalog
    path = roundtrip.scratch(spark, "variable-map")
    sinks.write_variable_map(spark, SPEC, path)
    back = spark.read.schema("variable string, index int, ohe_column string").json(f"{path}/json")
    roles = feature_catalog(spark, SPEC).select(F.col("feature").alias("variable"), "role", "is_binary", "use_log1p")
    cells = profile.missingness(profile.column_profile(panel.events_grid(spark, sf).select(*SPEC.features)))
    name = cells.columns[0]
    return back.join(roles, "variable").join(cells.select(F.col(name).alias("variable"), *cells.columns[1:]), "variable")


def q_union_splits(spark, sf):
    """The per-split panels, built apart, in one table with a split column."""
    g = panel.events_grid(spark, sf)
    return grid.union_splits({s: g.where(F.col("split") == s).drop("split") for s in ("a", "b", "c")}, SPEC)


def q_sorted_panel(spark, sf):
    """The cleaned panel in (id, time) order."""
    return prep.sort_panel(panel.events_clean(spark, sf), SPEC)


def q_entity_rows(spark, sf):
    """All panel rows of the labelled entities with a positive outcome."""
    out = tables.events_outcomes(spark, sf)
    chosen = out.where(F.col(out.columns[1]) == 1).select(F.col("id").alias("user_id"))
    return sampling.entity_rows(panel.events_grid(spark, sf), "user_id", chosen)


def q_store_report(spark, sf):
    return roundtrip.store_report(spark, sf)


def q_store_checks(spark, sf):
    return roundtrip.store_checks(spark, sf)


def q_summary_document(spark, sf):
    return roundtrip.summary_document(spark, sf)


def q_ledger_answers(spark, sf):
    return roundtrip.ledger_answers(spark, sf)


_QUERIES = {
    "store_report": q_store_report,
    "store_checks": q_store_checks,
    "summary_document": q_summary_document,
    "ledger_answers": q_ledger_answers,
    "experiment_grid": q_experiment_grid,
    "rf_engineered": q_rf_engineered,
    "outcomes_scan": q_outcomes_scan,
    "variable_map": q_variable_map,
    "union_splits": q_union_splits,
    "sorted_panel": q_sorted_panel,
    "entity_rows": q_entity_rows,
    "events_grid": q_events_grid,
    "events_clean": q_events_clean,
    "fill_defaults": q_fill_defaults,
    "events_ffill": q_events_ffill,
    "linear_panel": q_linear_panel,
    "scaler_params": q_scaler_params,
    "last_state": q_last_state,
    "engineered_features": q_engineered_features,
    "grid_summary": q_grid_summary,
    "token_params": q_token_params,
    "tokens": q_tokens,
    "token_counts": q_token_counts,
    "token_summary": q_token_summary,
    "fixed_sequences": q_fixed_sequences,
    "token_sequences": q_token_sequences,
    "mask_delta": q_mask_delta,
    "pool": q_pool,
    "static_row": q_static_row,
    "variable_series": q_variable_series,
    "length_stats": q_length_stats,
    "pad_batches": q_pad_batches,
    "ranking_metrics": q_ranking_metrics,
    "binary_metrics": q_binary_metrics,
    "scale_metrics": q_scale_metrics,
    "leaderboard": q_leaderboard,
    "select_best": q_select_best,
    "compare_experiments": q_compare,
    "history": q_history,
    "early_stopping": q_early_stopping,
    "split_counts": q_split_counts,
    "column_profile": q_column_profile,
    "value_counts": q_value_counts,
    "histogram": q_histogram,
    "log_histogram": q_log_histogram,
    "box_stats": q_box_stats,
    "time_profile": q_time_profile,
    "random_trajectories": q_random_trajectories,
    "shape": q_shape,
    "labelled_features": q_labelled_features,
    "budget_subsets": q_budget_subsets,
    "stratified": q_stratified,
    "distinct_ids": q_distinct_ids,
    "l2_normalize": q_l2_normalize,
    "extract_embeddings": q_extract_embeddings,
    "channel_mean": q_channel_mean,
    "channel_weighted": q_channel_weighted,
    "silhouette": q_silhouette,
    "davies_bouldin": q_davies_bouldin,
    "contingency": q_contingency,
    "random_projection": q_random_projection,
    "contrastive_batches": q_contrastive_batches,
    "contrastive_dataset": q_contrastive_dataset,
    "kmeans_report": q_kmeans_report,
    "pca": q_pca,
    "lineitem_features": q_lineitem_features,
    "patient_blocks": q_patient_blocks,
    "zero_shot_prompts": q_zero_shot_prompts,
    "few_shot_examples": q_few_shot_examples,
    "few_shot_prompts": q_few_shot_prompts,
    "model_answers": q_model_answers,
    "llm_eval_binary": q_llm_eval_binary,
    "llm_eval_scale": q_llm_eval_scale,
    "embedding_checks": q_embedding_checks,
    "embedding_verdict": q_embedding_verdict,
    "class_counts": q_class_counts,
    "id_agreement": q_id_agreement,
    "panel_expectations": q_panel_expectations,
    "grid_invariants": q_grid_invariants,
    "unique_ids": q_unique_ids,
    "raw_log_grid": q_raw_log_grid,
    "raw_log_rejects": q_raw_log_rejects,
    "embedding_manifest": q_embedding_manifest,
    "positional_embeddings": q_positional_embeddings,
    "params_roundtrip": q_params_roundtrip,
    "panel_roundtrip": q_panel_roundtrip,
    "lr_sweep": q_lr_sweep,
    "rf_sweep": q_rf_sweep,
    "gbt_sweep": q_gbt_sweep,
    "gbt_engineered": q_gbt_engineered,
    "lr_engineered": q_lr_engineered,
    "pos_weight": q_pos_weight,
    "linear_probe": q_linear_probe,
    "probe_threshold": q_probe_threshold,
    "label_scarcity": q_label_scarcity,
    "predictions": q_predictions,
    "standard_scaled": q_standard_scaled,
    "static_normalize": q_static_normalize,
    "missingness": q_missingness,
    "subset_ids": q_subset_ids,
    "masked_mean": q_masked_mean,
    "tokens_non_empty": q_tokens_non_empty,
    "positions": q_positions,
    "augment": q_augment,
    "summary_json": q_summary_json,
    "score_with": q_score_with,
    "side_by_side": q_side_by_side,
    "concat_features": q_concat_features,
    "results_roundtrip": q_results_roundtrip,
}

_ORACLES = {
    "store_report": O.sql_store_report,
    "store_checks": O.sql_store_checks,
    "summary_document": O.sql_summary_document,
    "ledger_answers": O.sql_ledger_answers,
    "augment": O.sql_augment,
    "summary_json": O.sql_summary_json,
    "experiment_grid": O.sql_experiment_grid,
    "outcomes_scan": O.sql_outcomes_scan,
    "variable_map": O.sql_variable_map,
    "union_splits": O.sql_grid,
    "sorted_panel": O.sql_clean,
    "entity_rows": O.sql_entity_rows,
    "events_grid": O.sql_grid,
    "events_clean": O.sql_clean,
    "fill_defaults": O.sql_fill_defaults,
    "events_ffill": O.sql_ffill,
    "linear_panel": O.sql_linear,
    "scaler_params": O.sql_scaler_params,
    "last_state": O.sql_last_state,
    "engineered_features": O.sql_engineered,
    "grid_summary": O.sql_grid_summary,
    "token_params": O.sql_token_params,
    "tokens": O.sql_tokens,
    "token_counts": O.sql_token_counts,
    "token_summary": O.sql_token_summary,
    "fixed_sequences": O.sql_fixed_sequences,
    "token_sequences": O.sql_token_sequences,
    "mask_delta": O.sql_mask_delta,
    "pool": O.sql_pool,
    "static_row": O.sql_static_row,
    "variable_series": O.sql_variable_series,
    "length_stats": O.sql_length_stats,
    "pad_batches": O.sql_pad_batches,
    "ranking_metrics": O.sql_ranking_metrics,
    "binary_metrics": O.sql_binary_metrics,
    "scale_metrics": O.sql_scale_metrics,
    "leaderboard": O.sql_leaderboard,
    "select_best": O.sql_select_best,
    "compare_experiments": O.sql_compare,
    "history": O.sql_history,
    "early_stopping": O.sql_early_stopping,
    "split_counts": O.sql_split_counts,
    "column_profile": O.sql_column_profile,
    "value_counts": O.sql_value_counts,
    "histogram": O.sql_histogram,
    "log_histogram": O.sql_log_histogram,
    "box_stats": O.sql_box_stats,
    "time_profile": O.sql_time_profile,
    "random_trajectories": O.sql_random_trajectories,
    "shape": O.sql_shape,
    "labelled_features": O.sql_labelled_features,
    "budget_subsets": O.sql_budget_subsets,
    "stratified": O.sql_stratified,
    "distinct_ids": O.sql_distinct_ids,
    "l2_normalize": O.sql_l2_normalize,
    "extract_embeddings": O.sql_extract_embeddings,
    "channel_mean": O.sql_channel_mean,
    "channel_weighted": O.sql_channel_weighted,
    "silhouette": O.sql_silhouette,
    "davies_bouldin": O.sql_davies_bouldin,
    "contingency": O.sql_contingency,
    "random_projection": O.sql_random_projection,
    "contrastive_batches": O.sql_contrastive_batches,
    "contrastive_dataset": O.sql_contrastive_dataset,
    "lineitem_features": O.sql_lineitem_features,
    "patient_blocks": O.sql_patient_blocks,
    "zero_shot_prompts": O.sql_zero_shot_prompts,
    "few_shot_examples": O.sql_few_shot_examples,
    "few_shot_prompts": O.sql_few_shot_prompts,
    "model_answers": O.sql_model_answers,
    "llm_eval_binary": O.sql_llm_eval_binary,
    "llm_eval_scale": O.sql_llm_eval_scale,
    "embedding_checks": O.sql_embedding_checks,
    "embedding_verdict": O.sql_embedding_verdict,
    "class_counts": O.sql_class_counts,
    "id_agreement": O.sql_id_agreement,
    "panel_expectations": O.sql_panel_expectations,
    "grid_invariants": O.sql_grid_invariants,
    "unique_ids": O.sql_unique_ids,
    "raw_log_grid": O.sql_raw_log_grid,
    "raw_log_rejects": O.sql_raw_log_rejects,
    "embedding_manifest": O.sql_embedding_manifest,
    "positional_embeddings": O.sql_positional_embeddings,
    "params_roundtrip": O.sql_scaler_params,
    "panel_roundtrip": O.sql_panel_roundtrip,
    "pos_weight": O.sql_pos_weight,
    "standard_scaled": O.sql_standard_scaled,
    "static_normalize": O.sql_static_normalize,
    "missingness": O.sql_missingness,
    "subset_ids": O.sql_subset_ids,
    "masked_mean": O.sql_masked_mean,
    "tokens_non_empty": O.sql_tokens_non_empty,
    "side_by_side": O.sql_side_by_side,
    "positions": O.sql_positions,
    "score_with": O.sql_score_with,
    "concat_features": O.sql_concat_features,
    "results_roundtrip": O.sql_leaderboard,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: raw events → daily causal panel → clean → train-fitted ffill → engineered features."""
    return queries()["engineered_features"](spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data subpackage and of the corpus pipeline, where they are installed."""
    try:
        import corpus_pipeline
        from hourglass.llm import queries as llm
    except ModuleNotFoundError as e:
        if not (e.name or "").startswith(("hourglass.llm", "corpus_pipeline")):
            raise
        return {}, {}
    sql = dict(llm.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def _configured(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**{k: _q(v) for k, v in _QUERIES.items()}, **{k: _configured(v) for k, v in _training_data()[0].items()}}


def oracle_sql() -> dict[str, str]:
    return {**{k: v() for k, v in _ORACLES.items()}, **_training_data()[1]}
