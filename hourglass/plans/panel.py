"""End-to-end panel plans over the bound driver tables (query lifecycle A and B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.operators import features, grid, prep
from hourglass.session import reuse
from hourglass.sources import tables
from hourglass.sources.tables import EVENTS_SPEC, LINEITEM_SPEC


def events_grid(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """Raw events → daily causal panel with statics, labels and split."""
    log = tables.events_log(spark, sf_dir)
    g = grid.build_grid(log, EVENTS_SPEC, tables.DAY_US, entities=tables.events_entities(spark, sf_dir, labelled))
    return tables.with_split(g, EVENTS_SPEC)


def events_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.clean_ranges(events_grid(spark, sf_dir), EVENTS_SPEC)


def events_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = reuse(events_clean(spark, sf_dir))
    defaults = prep.fit_fill_defaults(clean, EVENTS_SPEC)
    return prep.forward_fill(clean, EVENTS_SPEC, prep.params_dict(defaults))


def events_processed(spark: SparkSession, sf_dir: str, method: str = "exact"):
    """C10 over all splits: (ffill, linear, defaults, scaler)."""
    return prep.process_splits(events_grid(spark, sf_dir), EVENTS_SPEC, method)


def events_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: engineered per-user features on the forward-filled panel (F2 over C4 over G*)."""
    ff = events_ffill(spark, sf_dir)
    return tables.with_split(features.engineered(ff, EVENTS_SPEC), EVENTS_SPEC)


def lineitem_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.lineitem_log(spark, sf_dir)
    g = grid.build_grid(log, LINEITEM_SPEC, tables.LINEITEM_WIDTH_US)
    return tables.with_split(g, LINEITEM_SPEC)


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = reuse(prep.clean_ranges(lineitem_grid(spark, sf_dir), LINEITEM_SPEC))
    defaults = prep.fit_fill_defaults(clean, LINEITEM_SPEC)
    ff = prep.forward_fill(clean, LINEITEM_SPEC, prep.params_dict(defaults))
    return features.engineered(ff, LINEITEM_SPEC)


def events_token_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hourglass.operators import tokens
    return tokens.fit_value_scaler(events_clean(spark, sf_dir), EVENTS_SPEC)


def events_tokens(spark: SparkSession, sf_dir: str, one_hot: bool = True) -> DataFrame:
    """Cleaned, un-imputed panel → measurement tokens with train-fitted value scaling."""
    from hourglass.operators import tokens
    clean = reuse(events_clean(spark, sf_dir))
    params = prep.params_dict(tokens.fit_value_scaler(clean, EVENTS_SPEC))
    return tokens.tokenise(clean, EVENTS_SPEC, params, one_hot=one_hot)


def events_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (user, event type) the forward-filled daily series — the per-channel embedding table."""
    from hourglass.operators import sequences
    return sequences.variable_series(events_ffill(spark, sf_dir), EVENTS_SPEC).withColumnRenamed("variable", "var") \
        .withColumnRenamed("series", "embedding")


def events_last_state(spark: SparkSession, sf_dir: str, scaled: bool = True) -> DataFrame:
    """F1 per user on the linear (scaled) or forward-filled panel, with split."""
    p = events_processed(spark, sf_dir)[1] if scaled else events_ffill(spark, sf_dir)
    return tables.with_split(features.last_state(p, EVENTS_SPEC), EVENTS_SPEC)
