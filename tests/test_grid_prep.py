"""Grid construction and preparation against the hand-computed fixtures."""

import math

from pyspark.sql import functions as F

from hourglass.functions.exprs import binary01, ceil_bin, clock_minutes, safe_log1p
from hourglass.operators import grid, prep
from hourglass.sources import logs


def eav(spark, rows):
    """(id, time 'HH:MM', parameter, value, ord) → canonical log."""
    df = spark.createDataFrame(rows, "id long, time string, parameter string, value string, ord long")
    return df.select("id", clock_minutes("time").alias("elapsed"), "parameter", "value", "ord")


def test_ceil_bin_fixture(spark):
    df = spark.createDataFrame([(m,) for m in (0, 1, 60, 61, 2880, 2881)], "m long")
    assert [r[0] for r in df.select(ceil_bin("m", 60)).collect()] == [0, 1, 1, 2, 48, 49]


def test_sentinel_and_last_write_wins(spark, icu_spec):
    log = eav(spark, [(1, "00:10", "HR", "80", 1), (1, "00:50", "HR", "90", 2), (1, "00:55", "HR", "-1", 3)])
    g = grid.build_grid(log, icu_spec, 60)
    assert g.where("Time = 1").first()["HR"] == 90.0


def test_static_first_dynamic_last(spark, icu_spec):
    log = eav(spark, [(1, "00:00", "Weight", "70", 1), (1, "00:00", "Weight", "72", 2)])
    g = grid.build_grid(log, icu_spec, 60, static_map={"Weight_static": "Weight"})
    r = g.where("Time = 0").first()
    assert r["Weight_static"] == 70.0 and r["Weight"] == 72.0


def test_densify_only_record_id(spark, icu_spec):
    log = eav(spark, [(7, "00:00", "RecordID", "7", 1)])
    g = grid.build_grid(log, icu_spec, 60)
    assert g.count() == 49
    assert all(r[c] is None for r in g.collect() for c in icu_spec.features)


def test_bad_file_quarantined(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Time,Parameter,Value\r\n00:00,RecordID,5\r\n00:10,HR,80\r\n")
    (tmp_path / "b.txt").write_text("Time,Parameter,Value\n00:10,HR,81\n")
    log, rej = logs.with_entity(logs.scan_logs(spark, str(tmp_path)))
    assert [r["id"] for r in log.select("id").distinct().collect()] == [5]
    assert log.where("parameter = 'HR'").first()["value"] == "80"
    assert [r["file"].endswith("b.txt") for r in rej.collect()] == [True]


def test_range_cleaning(spark, icu_spec):
    df = spark.createDataFrame([(v,) for v in (30.0, 29.9, 45.0, 45.1)], "Temp double")
    out = [r[0] for r in prep.clean_ranges(df, icu_spec).collect()]
    assert out == [30.0, None, 45.0, None]


def test_mode_tie_lowest(spark, icu_spec):
    rows = [(1, t, g) for t, g in enumerate([0.0, 1.0, 0.0, 1.0, None])]
    df = spark.createDataFrame(rows, "PatientID long, Time long, Gender double")
    for c in icu_spec.features:
        if c != "Gender":
            df = df.withColumn(c, F.lit(None).cast("double"))
    d = prep.params_dict(prep.fit_fill_defaults(df, icu_spec))
    assert d["Gender"]["fill_value"] == 0.0 and d["MechVent"]["fill_value"] == 0.0 and d["HR"]["fill_value"] == 0.0


def test_forward_fill(spark, icu_spec):
    df = spark.createDataFrame([(1, t, v) for t, v in enumerate([None, 5.0, None, 7.0])], "PatientID long, Time long, HR double")
    out = prep.forward_fill(df, icu_spec, {"HR": {"fill_value": 3.0}}).orderBy("Time")
    assert [r["HR"] for r in out.collect()] == [3.0, 5.0, 5.0, 7.0]


def test_binary_half_even(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, -1.0)], "x double")
    assert [r[0] for r in df.select(binary01("x")).collect()] == [0.0, 1.0, 1.0, 0.0]


def test_log1p_guard(spark):
    df = spark.createDataFrame([(v,) for v in (-3.0, None, 0.0)], "x double")
    assert [r[0] for r in df.select(safe_log1p("x")).collect()] == [0.0, None, 0.0]


def test_robust_quantiles(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 10.0)], "x double")
    p = prep.params_dict(prep.fit_robust_scaler(df, ["x"]))["x"]
    assert math.isclose(p["median"], 3.0) and math.isclose(p["iqr"], 3.75)
    z = spark.createDataFrame([(4.0,), (4.0,), (4.0,)], "x double")
    p = prep.params_dict(prep.fit_robust_scaler(z, ["x"]))["x"]
    assert p["median"] == 4.0 and p["iqr"] == 1.0


def test_fill_is_idempotent_and_causal(spark, icu_spec):
    rows = [(1, t, (float(t) if t % 3 == 0 else None)) for t in range(10)]
    df = spark.createDataFrame(rows, "PatientID long, Time long, HR double")
    once = prep.forward_fill(df, icu_spec, {"HR": {"fill_value": -5.0}})
    twice = prep.forward_fill(once, icu_spec, {"HR": {"fill_value": -5.0}})
    assert sorted(once.collect()) == sorted(twice.collect())
    # changing rows after t = 4 never changes output at t <= 4
    later = df.withColumn("HR", F.when(F.col("Time") > 4, F.lit(99.0)).otherwise(F.col("HR")))
    a = prep.forward_fill(df, icu_spec, {"HR": {"fill_value": -5.0}}).where("Time <= 4").collect()
    b = prep.forward_fill(later, icu_spec, {"HR": {"fill_value": -5.0}}).where("Time <= 4").collect()
    assert sorted(a) == sorted(b)


def test_grid_partition_invariance(spark, icu_spec):
    rows = [(i % 7, f"{(i * 13) % 50:02d}:{(i * 7) % 60:02d}", ("HR", "Temp", "Weight")[i % 3], str(30 + i % 17), i)
            for i in range(400)]
    log = eav(spark, rows)
    a = grid.build_grid(log.repartition(1), icu_spec, 60).collect()
    b = grid.build_grid(log.repartition(13), icu_spec, 60).collect()
    assert sorted(a) == sorted(b) and len(a) == 7 * 49
