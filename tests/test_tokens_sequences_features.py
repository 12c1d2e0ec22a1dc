"""Tokens, sequences and entity features against the hand-computed fixtures."""

import math

from pyspark.sql import functions as F

from hourglass.operators import features, sequences, tokens


def panel(spark, spec, values):
    """One entity, 49 steps; values: {feature: {step: value}}."""
    rows = []
    for t in range(spec.n_steps):
        rows.append(tuple([1, t] + [values.get(c, {}).get(t) for c in spec.features]))
    schema = "PatientID long, Time long, " + ", ".join(f"{c} double" for c in spec.features)
    return spark.createDataFrame(rows, schema)


def test_tokens_static_once(spark, icu_spec):
    p = panel(spark, icu_spec, {"Age": {t: 60.0 for t in range(49)}, "HR": {24: 80.0}})
    params = {c: {"is_binary": c in icu_spec.binary, "use_log1p": False, "median": 0.0, "iqr": 1.0}
              for c in icu_spec.features}
    tok = tokens.tokenise(p, icu_spec, params).orderBy("t_scaled").collect()
    assert [(r["var_idx"], r["t_scaled"]) for r in tok] == [(0, 0.0), (4, 0.5)]
    assert tok[1]["var_HR"] == 1 and tok[1]["var_Age"] == 0


def test_mask_delta_fixture(spark, icu_spec):
    df = spark.createDataFrame([(1, t, (1.0 if t in (2, 4) else None)) for t in range(6)],
                               "PatientID long, Time long, HR double")
    out = sequences.mask_delta(df, icu_spec).orderBy("Time").collect()
    assert [r["delta_HR"] for r in out] == [1.0, 2.0, 0.0, 1.0, 0.0, 1.0]
    assert [r["mask_HR"] for r in out] == [0, 0, 1, 0, 1, 0]


def test_recency_pool_zero_strength(spark, icu_spec):
    from hourglass.spec import PanelSpec

    spec2 = PanelSpec(**{**icu_spec.__dict__, "n_steps": 2})
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, 4.0)], "PatientID long, Time long, HR double")
    r = sequences.pool(df, spec2, ["HR"], strength=0.0).first()
    assert r["HR_recency"] == 3.0 and r["HR_mean"] == 3.0 and r["HR_last"] == 4.0 and r["HR_max"] == 4.0


def test_pad_batches(spark, icu_spec):
    seqs = spark.createDataFrame([(1, [[1.0], [2.0]]), (2, [[1.0], [2.0], [3.0]])], "PatientID long, seq array<array<double>>")
    out = sequences.pad_batches(seqs, icu_spec, 2).orderBy("PatientID").collect()
    assert [r["max_len"] for r in out] == [3, 3]
    assert out[0]["pad_mask"] == [False, False, True] and out[1]["pad_mask"] == [False, False, False]
    assert out[0]["padded"][2] == [0.0]


def test_last_state_non_null(spark, icu_spec):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, 6.0), (1, 2, None)], "PatientID long, Time long, HR double")
    assert features.last_state(df, icu_spec).first()["HR"] == 6.0


def test_engineered_stats(spark):
    from hourglass.spec import PanelSpec

    spec = PanelSpec(id_col="id", time_col="t", target_col="label", static=(), dynamic=("y",), n_steps=4)
    df = spark.createDataFrame([(1, t, float(2 * t + 1)) for t in range(4)], "id long, t long, y double")
    r = features.engineered(df, spec).first()
    assert (r["y_first"], r["y_last"], r["y_mean"], r["y_min"], r["y_max"], r["y_delta"]) == (1, 7, 4, 1, 7, 6)
    assert math.isclose(r["y_std"], math.sqrt(5)) and math.isclose(r["y_slope"], 2.0)
    one = spark.createDataFrame([(1, 0, 3.0), (1, 1, None)], "id long, t long, y double")
    assert features.engineered(one, spec).first()["y_slope"] == 0.0


def test_pos_weight_modes(spark):
    df = spark.createDataFrame([(0,)] * 8, "label int")
    assert features.scale_pos_weight(df, "label", "classic").first()["pos_weight"] == 1.0
    assert features.scale_pos_weight(df, "label", "deep").first()["pos_weight"] == 8.0


def test_partition_invariance(spark, icu_spec):
    rows = [(i, t, float((i * 7 + t) % 11) if (i + t) % 3 else None) for i in range(20) for t in range(5)]
    df = spark.createDataFrame(rows, "PatientID long, Time long, HR double")
    a = features.last_state(df.repartition(1), icu_spec).collect()
    b = features.last_state(df.repartition(13), icu_spec).collect()
    assert sorted(a) == sorted(b)


def test_concat_one_pass_equals_join(spark, icu_spec):
    from hourglass.operators import prep

    rows = [(i, t) + tuple(((float((i * 3 + t * 5 + k) % 11) + 31.0) if (i + t + k) % 4 else None)
                           for k, _ in enumerate(icu_spec.features)) for i in range(5) for t in range(6)]
    schema = "PatientID long, Time long, " + ", ".join(f"{c} double" for c in icu_spec.features)
    clean = spark.createDataFrame(rows, schema)
    defaults = {c: {"fill_value": 1.5} for c in icu_spec.features}
    ff = prep.forward_fill(clean, icu_spec, defaults)
    scaler = prep.params_dict(prep.fit_robust_scaler(prep.linear_transform(ff, icu_spec), icu_spec.scaled))
    joined = sequences.concat_features(prep.make_linear(ff, icu_spec, scaler), sequences.mask_delta(clean, icu_spec),
                                       icu_spec).collect()
    one = sequences.concat_one_pass(clean, icu_spec, defaults, scaler).collect()
    norm = lambda rs: sorted((r[0], r[1], [round(v, 9) for v in r[2]]) for r in rs)
    assert norm(joined) == norm(one)
