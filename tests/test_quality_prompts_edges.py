"""Edge cases: non-finite embeddings, one class, empty prompt blocks, empty token scaler column."""

from pyspark.sql import functions as F

from hourglass.operators import prompts, quality, tokens


def test_embedding_checks_flag_problems(spark):
    df = spark.createDataFrame([([1.0, float("nan")], 1), ([0.5, 2.0], 1)], "embedding array<double>, label int")
    st = {r["check"]: r["status"] for r in quality.embedding_checks(df).collect()}
    assert st["finite"] == "FAIL" and st["two_classes"] == "FAIL" and st["binary_labels"] == "WARN"
    assert st["non_empty"] == "OK" and st["uniform_width"] == "OK" and st["tsne_feasible"] == "FAIL"
    assert quality.verdict(quality.embedding_checks(df)).first()["verdict"] == "FAIL"


def test_prompt_blocks_fallbacks(spark, icu_spec):
    rows = [(1, t) + (None,) * len(icu_spec.features) for t in range(3)]
    schema = "PatientID long, Time long, " + ", ".join(f"{c} double" for c in icu_spec.features)
    b = prompts.patient_blocks(spark.createDataFrame(rows, schema), icu_spec, prompts.PromptSpec()).first()
    assert b["static_block"] == prompts.NO_STATIC and b["dynamic_block"] == prompts.NO_DYNAMIC


def test_prompt_blocks_lines(spark, icu_spec):
    vals = {"Age": 54.5, "Gender": 1.0, "Height": None, "Weight_static": 80.25, "HR": 71.005, "MechVent": 1.0,
            "Temp": None, "Weight": None}
    rows = [(1, 0) + tuple(vals[c] for c in icu_spec.features), (1, 1) + tuple(
        (90.0 if c == "HR" else None) for c in icu_spec.features)]
    schema = "PatientID long, Time long, " + ", ".join(f"{c} double" for c in icu_spec.features)
    b = prompts.patient_blocks(spark.createDataFrame(rows, schema), icu_spec, prompts.PromptSpec()).first()
    assert b["static_block"].split("\n") == ["  - Age: 54 years", "  - Gender: Male", "  - Weight (admission): 80.2 kg",
                                             "  - Mechanical Ventilation: Yes"]
    assert b["dynamic_block"] == "  - HR: min=71.00, max=90.00"


def test_value_scaler_empty_column(spark, icu_spec):
    rows = [(1, t, 60.0, None) for t in range(3)]
    df = spark.createDataFrame(rows, "PatientID long, Time long, Age double, HR double")
    for c in icu_spec.features:
        if c not in ("Age", "HR"):
            df = df.withColumn(c, F.lit(None).cast("double"))
    p = {r["column"]: r for r in tokens.fit_value_scaler(df, icu_spec).collect()}
    assert (p["HR"]["median"], p["HR"]["iqr"]) == (0.0, 1.0)
    assert p["Gender"]["is_binary"] and (p["Age"]["median"], p["Age"]["iqr"]) == (60.0, 1.0)
