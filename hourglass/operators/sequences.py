"""Sequences (Q1–Q12): per-entity ordered arrays, masks/deltas, padding, pooling and augmentation.

Every per-entity collection is bounded by the spec (n_steps rows, or n_steps × n_features tokens), never
by the data size. Per-row randomness is a seeded hash of (seed, id, view, step, channel), so results are
identical under task retries.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.exprs import draw_rank, md5_unit
from hourglass.functions.indexing import global_index
from hourglass.spec import PanelSpec


def _sorted_rows(spec: PanelSpec, feats: list[str], key):
    return F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.array(*[F.col(c).cast("double") for c in feats]).alias("x")))),
                       lambda s: s["x"])


def fixed_sequences(panel: DataFrame, spec: PanelSpec, strict: bool = True) -> DataFrame:
    """Q1: ``(id, seq array<array<double>> [n_steps × n_features], label, length)``, ordered by time.

    With ``strict`` a sequence whose length differs from n_steps raises (``raise_error``).
    """
    feats = [c for c in spec.features if c in panel.columns]
    aggs = [_sorted_rows(spec, feats, F.col(spec.time_col)).alias("seq")]
    if spec.target_col in panel.columns:
        aggs.append(F.min_by(spec.target_col, spec.time_col).alias(spec.target_col))
    out = panel.groupBy(spec.id_col).agg(*aggs).withColumn("length", F.size("seq"))
    if strict:
        out = out.withColumn("length", F.when(F.col("length") == spec.n_steps, F.col("length")).otherwise(
            F.raise_error(F.format_string("sequence of id %s has length %d, expected %d",
                                          F.col(spec.id_col).cast("string"), F.col("length"), F.lit(spec.n_steps)))))
    return out


def token_sequences(tokens: DataFrame, spec: PanelSpec) -> DataFrame:
    """Q2: ragged token sequences ordered by (t_scaled, var_idx); token = [t_scaled, value_scaled, one-hot…]."""
    req = {spec.id_col, "t_scaled", "value_scaled", "var_idx"}
    missing = req - set(tokens.columns)
    if missing:
        raise ValueError(f"token table lacks required columns: {sorted(missing)}")
    nf = len(spec.features)
    vec = F.concat(F.array(F.col("t_scaled"), F.col("value_scaled")),
                   F.transform(F.sequence(F.lit(0), F.lit(nf - 1)),
                               lambda i: (i == F.col("var_idx")).cast("double")))
    key = F.struct(F.col("t_scaled"), F.col("var_idx"))
    aggs = [F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), vec.alias("x")))), lambda s: s["x"]).alias("seq")]
    if spec.target_col in tokens.columns:
        aggs.append(F.first(spec.target_col, ignorenulls=True).alias(spec.target_col))
    return tokens.groupBy(spec.id_col).agg(*aggs).withColumn("length", F.size("seq"))


def mask_delta_exprs(spec: PanelSpec, feats: list[str]):
    """Q3 expressions: ``mask_c`` = observed; ``delta_c`` = t − last observed t (≤ t), or t + 1 if never."""
    w = (Window.partitionBy(spec.id_col).orderBy(spec.time_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    t = F.col(spec.time_col)
    out = []
    for c in feats:
        out.append(F.col(c).isNotNull().cast("int").alias(f"mask_{c}"))
    for c in feats:
        seen = F.last(F.when(F.col(c).isNotNull(), t), ignorenulls=True).over(w)
        out.append(F.coalesce(t - seen, t + 1).cast("double").alias(f"delta_{c}"))
    return out


def mask_delta(raw: DataFrame, spec: PanelSpec) -> DataFrame:
    """Q3 on the raw (un-imputed) panel, all features, one Window node."""
    feats = [c for c in spec.features if c in raw.columns]
    keep = [c for c in [spec.id_col, spec.time_col, spec.target_col, spec.split_col] if c in raw.columns]
    return raw.select(*keep, *mask_delta_exprs(spec, feats))


def concat_features(base: DataFrame, md: DataFrame, spec: PanelSpec) -> DataFrame:
    """Q4: base ‖ mask ‖ delta per (id, time) as one array (n → 3n), joined on the key, not by position."""
    feats = [c for c in spec.features if c in base.columns]
    b = base.select(spec.id_col, spec.time_col, F.array(*[F.col(c).cast("double") for c in feats]).alias("b"))
    m = md.select(spec.id_col, spec.time_col,
                  F.array(*[F.col(f"mask_{c}").cast("double") for c in feats]).alias("m"),
                  F.array(*[F.col(f"delta_{c}") for c in feats]).alias("d"))
    return b.join(m, [spec.id_col, spec.time_col]).select(
        spec.id_col, spec.time_col, F.concat("b", "m", "d").alias("x"))


def pad_batches(seqs: DataFrame, spec: PanelSpec, batch_size: int, seq_col: str = "seq") -> DataFrame:
    """Q5: consecutive batches of ``batch_size`` entities in id order; pad each sequence with zero rows to
    the longest in its batch; ``pad_mask`` is True on padded steps.
    """
    idx = global_index(seqs, [spec.id_col], "pos")
    b = idx.withColumn("batch_id", F.floor(F.col("pos") / F.lit(batch_size)).cast("bigint"))
    w = Window.partitionBy("batch_id")
    width = F.size(F.col(seq_col)[0])
    b = b.withColumn("max_len", F.max(F.size(seq_col)).over(w))
    pad_n = F.col("max_len") - F.size(seq_col)
    zero_row = F.transform(F.sequence(F.lit(1), width), lambda _: F.lit(0.0))
    return b.select(
        spec.id_col, "batch_id", "pos", F.size(seq_col).alias("length"), "max_len",
        F.concat(F.col(seq_col), F.array_repeat(zero_row, pad_n)).alias("padded"),
        F.concat(F.array_repeat(F.lit(False), F.size(seq_col)), F.array_repeat(F.lit(True), pad_n)).alias("pad_mask"),
        *([spec.target_col] if spec.target_col in seqs.columns else []))


def pool(panel: DataFrame, spec: PanelSpec, feats: list[str] | None = None, strength: float = 2.0) -> DataFrame:
    """Q6: temporal pooling per entity and feature: last, mean, max and recency-weighted mean with
    ``w_t ∝ exp(strength · t)``, ``t = step / (n_steps − 1)`` (linspace(0, 1, T)).
    """
    feats = feats or [c for c in spec.features if c in panel.columns]
    t = F.col(spec.time_col)
    denom = float(max(spec.n_steps - 1, 1))
    w = F.exp(F.lit(float(strength)) * t.cast("double") / F.lit(denom))
    aggs = []
    for c in feats:
        aggs += [F.max_by(c, t).alias(f"{c}_last"), F.avg(c).alias(f"{c}_mean"), F.max(c).alias(f"{c}_max"),
                 (F.sum(w * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), w))).alias(f"{c}_recency")]
    return panel.groupBy(spec.id_col).agg(*aggs)


def masked_mean(padded: DataFrame, seq_col: str = "padded", mask_col: str = "pad_mask") -> DataFrame:
    """Q7: mean over valid (un-padded) steps per dimension; denominator floored at 1."""
    valid = F.aggregate(F.col(mask_col), F.lit(0), lambda acc, m: acc + F.when(~m, 1).otherwise(0))
    width = F.size(F.col(seq_col)[0])
    zipped = F.arrays_zip(F.col(seq_col).alias("x"), F.col(mask_col).alias("m"))
    sums = F.transform(F.sequence(F.lit(0), width - 1), lambda d: F.aggregate(
        zipped, F.lit(0.0), lambda acc, s: acc + F.when(~s["m"], s["x"][d]).otherwise(0.0)))
    return padded.withColumn("pooled", F.transform(sums, lambda s: s / F.greatest(valid, F.lit(1))))


def add_positions(seqs: DataFrame, max_len: int, seq_col: str = "seq") -> DataFrame:
    """Q8 applied: add the encoding row-wise; a sequence longer than the table raises."""
    dim = F.size(F.col(seq_col)[0])
    pe = lambda p, d: F.when(d % 2 == 0, F.sin(p / F.pow(F.lit(10000.0), (d - d % 2).cast("double") / dim.cast("double")))) \
        .otherwise(F.cos(p / F.pow(F.lit(10000.0), (d - d % 2).cast("double") / dim.cast("double"))))
    checked = F.when(F.size(seq_col) <= max_len, F.col(seq_col)).otherwise(
        F.raise_error(F.format_string("sequence length %d exceeds positional table %d", F.size(seq_col), F.lit(max_len))))
    out = F.transform(checked, lambda row, p: F.transform(
        row, lambda x, d: x + pe(p.cast("double"), d)))
    return seqs.withColumn(seq_col, out)


def augment(seqs: DataFrame, spec: PanelSpec, seed: int = 42, view: int = 0, crop_len: int = 32,
            noise_std: float = 0.05, drop_p: float = 0.10, seq_col: str = "seq") -> DataFrame:
    """Q9: one augmented view: random crop (start uniform in [0, T − crop_len]), Gaussian noise
    (Box–Muller from two hashed uniforms) and whole-channel dropout with probability ``drop_p``.
    Sequences shorter than ``crop_len`` raise. Views with different ``view`` numbers are independent.
    """
    n = F.size(seq_col)
    span = n - F.lit(crop_len) + 1
    start = F.when(n >= crop_len, F.pmod(draw_rank(seed, f"crop-{view}", spec.id_col), span)) \
        .otherwise(F.raise_error(F.format_string("sequence of length %d is shorter than crop %d", n, F.lit(crop_len))))
    cropped = F.slice(seq_col, (start + 1).cast("int"), crop_len)
    idc = F.col(spec.id_col)

    def noisy(row, i):
        return F.transform(row, lambda x, d: F.when(
            md5_unit(seed, f"drop-{view}", idc, d) < F.lit(drop_p), F.lit(0.0)).otherwise(
            x + F.lit(noise_std) * F.sqrt(F.lit(-2.0) * F.log(md5_unit(seed, f"u1-{view}", idc, i, d)))
            * F.cos(F.lit(2 * math.pi) * md5_unit(seed, f"u2-{view}", idc, i, d))))

    return seqs.withColumn(f"view{view}", F.transform(cropped, noisy))


def variable_series(panel: DataFrame, spec: PanelSpec, feats: list[str] | None = None) -> DataFrame:
    """Q10: per (entity, variable) the time-ordered series; any missing value raises."""
    feats = feats or list(spec.dynamic)
    t = F.col(spec.time_col)
    long = panel.select(spec.id_col, t, F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("v")) for c in feats])).alias("kv"))
    return (long.groupBy(spec.id_col, F.col("kv.variable").alias("variable"))
            .agg(F.transform(F.array_sort(F.collect_list(F.struct(t.alias("k"), F.col("kv.v").alias("v")))),
                             lambda s: s["v"]).alias("series"),
                 F.sum(F.col("kv.v").isNull().cast("int")).alias("n_missing"))
            .withColumn("series", F.when(F.col("n_missing") == 0, F.col("series")).otherwise(
                F.raise_error(F.format_string("missing value in series of %s / %s",
                                              F.col(spec.id_col).cast("string"), F.col("variable")))))
            .drop("n_missing"))


def static_row(panel: DataFrame, spec: PanelSpec, cols: list[str] | None = None) -> DataFrame:
    """Q11: one static row per entity taken from its first time step."""
    cols = cols or list(spec.static)
    first = F.min_by(F.struct(*[F.col(c) for c in cols]), spec.time_col).alias("s")
    return panel.groupBy(spec.id_col).agg(first).select(spec.id_col, "s.*")


def length_stats(seqs: DataFrame, group_col: str | None = None) -> DataFrame:
    """Q12: average and maximum sequence length (per group if given, else overall)."""
    keys = [group_col] if group_col else []
    return seqs.groupBy(*keys).agg(F.avg("length").alias("avg_length"), F.max("length").alias("max_length"),
                                   F.count(F.lit(1)).alias("n_sequences"))


def concat_one_pass(clean: DataFrame, spec: PanelSpec, defaults: dict, scaler: dict) -> DataFrame:
    """Q4 without a join: forward fill + linear transform (C4–C9 with fitted ``defaults`` / ``scaler``)
    and mask / delta (Q3) computed from the same raw rows under ONE window, then concatenated.
    One Exchange by entity instead of two window pipelines joined on (id, time)."""
    from hourglass.functions.exprs import binary01, safe_log1p

    w = (Window.partitionBy(spec.id_col).orderBy(spec.time_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    feats = [c for c in spec.features if c in clean.columns]
    base = []
    for c in feats:
        x = F.last(c, ignorenulls=True).over(w)
        if c in defaults:
            x = F.coalesce(x, F.lit(float(defaults[c]["fill_value"])))
        if c in spec.binary:
            x = binary01(binary01(x))
        elif c in spec.log:
            x = safe_log1p(x)
        if c in scaler:
            med = scaler[c]["median"]
            x = (x - F.lit(0.0 if med is None else float(med))) / F.lit(float(scaler[c]["iqr"]))
        base.append(x.cast("double"))
    md = mask_delta_exprs(spec, feats)
    masks = [e.cast("double") for e in md[:len(feats)]]
    deltas = md[len(feats):]
    return clean.select(spec.id_col, spec.time_col, F.concat(F.array(*base), F.array(*masks), F.array(*deltas)).alias("x"))
