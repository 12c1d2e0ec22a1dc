"""Draw independence, model calls, log faults, label faults and channel weights."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators import grid, prompts, quality, sampling, vectors
from hourglass.sources import logs, sinks


def test_draws_are_independent_and_take_large_ids(spark):
    ids = spark.range(4_000_000_000, 4_000_004_000).withColumnRenamed("id", "k")
    got = {}
    for r in sampling.budget_subsets(ids, "k", (100, 500), seed=1).collect():
        got.setdefault(r["budget"], set()).add(r["k"])
    assert len(got["100"]) == 100 and len(got["500"]) == 500 and len(got["full"]) == 4000
    # 12.5 of the 100 are expected among the 500; nested or disjoint draws give 100 or 0
    assert 1 <= len(got["100"] & got["500"]) <= 32
    again = sampling.budget_subsets(ids, "k", (100,), seed=2).where("budget = '100'").collect()
    assert {r["k"] for r in again} != got["100"]


def test_subset_carries_the_list_order(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(20)], "k long, v string")
    ids = spark.createDataFrame([(7, 0), (3, 1), (11, 2)], "k long, position int")
    assert [r["k"] for r in sampling.subset_by_ids(df, ids, "k", "position").collect()] == [7, 3, 11]


@pytest.mark.parametrize("mode, good", [("binary", '{"prediction": "dead"}'), ("scale", '{"prediction": 7}')])
def test_one_call_per_row_and_retry_of_bad_answers(spark, tmp_path, mode, good):
    calls = tmp_path / "calls"

    def factory(first_bad):
        def make():
            seen = {}

            def client(prompt):
                with open(calls, "a") as f:
                    f.write("x")
                seen[prompt] = seen.get(prompt, 0) + 1
                if first_bad and seen[prompt] == 1:
                    return "garbage"
                return good
            return client
        return make

    rows = spark.createDataFrame([(i, i % 2, f"p{i}") for i in range(20)], "id long, label int, prompt string")
    prompts.evaluate_answers(prompts.call_model(rows, factory(False), mode=mode), "label", mode).collect()
    assert len(calls.read_text()) == 20
    calls.write_text("")
    out = prompts.call_model(rows, factory(True), mode=mode).collect()
    assert len(calls.read_text()) == 40 and all(r["prediction"] is not None for r in out)


@pytest.mark.parametrize("text", ['{"prediction": " Dead "}', 'x {"prediction": "alive"} y', '{"prediction": "maybe"}', "none", None,
                                  '{"prediction": 3}', '{"prediction": "9"}', '{"prediction": 11}', '{"prediction": 4.0}', '{"prediction": 4.5}', '{"other": 1}'])
def test_retry_rule_agrees_with_parsing(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(prompts.parse_binary(F.col("t")).alias("b"), prompts.parse_scale(F.col("t")).alias("s")).first()
    assert prompts.valid_answer(text, "binary") == (row["b"] is not None)
    assert prompts.valid_answer(text, "scale") == (row["s"] is not None)


def test_faulty_files_are_quarantined_and_nan_is_missing(spark, icu_spec, tmp_path):
    head = "Time,Parameter,Value\n"
    files = {"good": "00:00,RecordID,1\n00:00,Age,nan\n00:00,HR,70\n00:30,HR,80\n00:40,HR,nan\n02:00,HR,x\n02:10,HR,90\nnoon,Other,1\n",
             "no_id": "00:00,HR,70\n", "bad_id": "00:00,RecordID,abc\n", "bad_time": "00:00,RecordID,2\nnoon,HR,70\n",
             "bad_static": "00:00,RecordID,3\n00:00,Age,old\n"}
    for name, body in files.items():
        (tmp_path / f"{name}.txt").write_text(head + body)
    log, rejects = logs.with_entity(logs.scan_logs(spark, str(tmp_path)), icu_spec.dynamic, ("Age",))
    found = {r["file"].rsplit("/", 1)[1][:-4]: r["reason"] for r in rejects.collect()}
    assert found == {"no_id": "no RecordID row", "bad_id": "unparseable RecordID", "bad_time": "malformed time",
                     "bad_static": "non-numeric static Age"}
    assert "Join" not in log._jdf.queryExecution().optimizedPlan().toString()
    panel = grid.build_grid(log, icu_spec, 60, static_map={"Age": "Age"})
    rows = {r["Time"]: r for r in panel.collect()}
    assert rows[0]["HR"] == 70 and rows[1]["HR"] is None and rows[3]["HR"] == 90 and rows[0]["Age"] is None
    sinks.write_panel(panel.withColumn("HR", F.coalesce("HR", F.lit(float("nan")))), str(tmp_path / "panel"))
    back = {r["Time"]: r["HR"] for r in sinks.read_panel(spark, str(tmp_path / "panel")).collect()}
    assert back[0] == 70 and back[1] is None


def test_uncastable_label_fails_the_check(spark):
    emb = spark.createDataFrame([([1.0, 2.0], "1"), ([1.0, 3.0], "abc")], "embedding array<double>, label string")
    assert {r["check"]: r["status"] for r in quality.embedding_checks(emb).collect()}["labels_castable"] == "FAIL"


def test_channel_without_weight_is_an_error(spark):
    ch = spark.createDataFrame([(1, "a", [1.0, 2.0]), (1, "b", [3.0, 4.0])], "id long, var string, embedding array<double>")
    got = vectors.channel_weighted(ch, "id", {"a": 0.0, "b": 0.0}).first()["embedding"]
    assert np.allclose(got, [2.0, 3.0])
    with pytest.raises(Exception, match="no weight for channel b"):
        vectors.channel_weighted(ch, "id", {"a": 0.0}).collect()


def test_cluster_bound_holds_before_collecting(spark):
    emb = spark.range(30).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("e"), F.col("id").alias("c"))
    with pytest.raises(ValueError, match="more than 10"):
        vectors.silhouette(emb, "e", "c", max_clusters=10)
