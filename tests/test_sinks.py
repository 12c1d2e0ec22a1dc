"""Sinks: variable map, JSON summary with non-finite values, params CSV round trip."""

import json

from hourglass.sources import sinks


def test_variable_map(spark, icu_spec, tmp_path):
    vm = sinks.variable_map(spark, icu_spec).orderBy("index").collect()
    assert [(r["variable"], r["index"], r["ohe_column"]) for r in vm][:2] == [("Age", 0, "var_Age"), ("Gender", 1, "var_Gender")]
    sinks.write_variable_map(spark, icu_spec, str(tmp_path / "vm"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "vm" / "csv"))
    assert back.count() == len(icu_spec.features)


def test_summary_json_nonfinite_to_null(spark):
    df = spark.createDataFrame([(1, float("nan"), float("inf"), [1.0, float("-inf")])],
                               "k int, a double, b double, v array<double>")
    doc = json.loads(sinks.summary_json(df).first()["json"])
    assert doc == {"k": 1, "a": None, "b": None, "v": [1.0, None]}


def test_params_csv_round_trip(spark, tmp_path):
    p = spark.createDataFrame([("HR", 80.0, 12.5)], sinks.PARAMS_SCHEMA)
    sinks.write_params(p, str(tmp_path / "p"))
    assert sinks.read_params(spark, str(tmp_path / "p")).collect() == p.collect()
