"""Answers that must not crash a task, and the ledger (one call per prompt)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hourglass.operators import answer_ledger as L
from hourglass.operators import prompts

HARD = ['{"prediction": NaN}', '{"prediction": Infinity}', '{"prediction": -Infinity}', '{"prediction": 1e999}', '{"prediction": -1e999}',
        json.dumps({"prediction": "9" * 5000}), '{"prediction": ' + "9" * 5000 + "}", '{"prediction": ' + "[" * 100_000, '{"prediction": "0007"}',
        '{"prediction": true}', '{"prediction": null}', '{"prediction": {}}', '{"prediction": "٧"}', '[1]', '"x"', "7", ""]


@pytest.mark.parametrize("mode", ["binary", "scale"])
def test_no_answer_crashes_a_task(spark, mode):
    rows = spark.createDataFrame([(i, 1, str(i)) for i in range(len(HARD) + 2)], "id long, label int, prompt string")

    def factory():
        def client(prompt):
            i = int(prompt)
            return HARD[i] if i < len(HARD) else [{"prediction": "dead"}, 7][i - len(HARD)]
        return client

    got = {r.id: r.prediction for r in prompts.call_model(rows, factory, mode=mode).collect()}
    assert len(got) == len(HARD) + 2
    for i, text in enumerate(HARD):
        assert (got[i] is not None) == prompts.valid_answer(text, mode), text[:40]
    assert {i for i, v in got.items() if v is not None} == ({HARD.index('{"prediction": "0007"}')} if mode == "scale" else set())


def counting(folder, answer='{"prediction": "dead"}', dies_at=None):
    def factory():
        def client(prompt):
            flag = os.path.join(folder, "died")
            if prompt == dies_at and not os.path.exists(flag):
                open(flag, "w").close()
                os._exit(1)  # the worker is lost, as with its executor
            with open(os.path.join(folder, "calls"), "a") as f:
                f.write(prompt + "\n")
            return answer
        return client
    return factory


def calls(folder):
    path = os.path.join(folder, "calls")
    return sorted(open(path).read().split()) if os.path.exists(path) else []


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, i % 2, f"p{i % 30:02d}") for i in range(60)] + [(60, 1, None)], "id long, label int, prompt string")


def test_a_repeated_run_asks_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "ledger")
    (tmp_path / "log").mkdir()
    make = counting(str(tmp_path / "log"))
    got = L.call_with_ledger(rows, make, path, chunk=4).collect()
    assert len(got) == 61 and calls(tmp_path / "log") == [f"p{i:02d}" for i in range(30)]
    assert {r.prediction for r in got if r.id < 60} == {"dead"} and [r.prediction for r in got if r.id == 60] == [None]
    assert L.ask_missing(rows, make, path) == 0
    more = rows.unionByName(spark.createDataFrame([(99, 1, "new")], rows.schema))
    assert L.ask_missing(more, make, path) == 1
    assert calls(tmp_path / "log") == sorted([f"p{i:02d}" for i in range(30)] + ["new"])
    # the other mode asks another question
    assert L.ledger_answers(rows, path, mode="scale").where("response is not null").isEmpty()


def test_a_lost_worker_repeats_no_saved_call(spark, tmp_path, rows):
    path, log = str(tmp_path / "ledger"), tmp_path / "log"
    log.mkdir()
    order = [r.prompt for r in rows.where("prompt is not null").select("prompt", L.prompt_key("binary").alias("key")).distinct()
             .repartition(1, "key").collect()]
    with pytest.raises(Exception, match="."):  # local masters do not retry tasks, so the run fails ...
        L.ask_missing(rows, counting(str(log), dies_at=order[17]), path, in_flight=1, chunk=1, tasks=1)
    first = calls(log)
    assert 0 < len(first) < 30
    assert L.ask_missing(rows, counting(str(log)), path, in_flight=1, chunk=1, tasks=1) == 30 - len(first)  # ... and the next goes on
    assert calls(log) == [f"p{i:02d}" for i in range(30)]


def test_a_rerun_task_reads_what_its_earlier_attempt_saved(tmp_path):
    folder = str(tmp_path / "run-x" / "task-0")
    assert L._answers_of(folder) == {}
    L._save(folder, "binary", [("a", "1"), ("b", "2")])
    L._save("file:" + folder, "binary", [("c", "3")])
    (tmp_path / "run-x" / "task-0" / ".half").write_text("not complete")
    assert L._answers_of(folder) == {"a": "1", "b": "2", "c": "3"}


def test_failed_calls_are_asked_again_and_bad_answers_are_kept(spark, tmp_path, rows):
    def broken():
        def client(prompt):
            raise OSError("down")
        return client

    path, log = str(tmp_path / "ledger"), tmp_path / "log"
    log.mkdir()
    assert L.ask_missing(rows, broken, path) == 0
    assert L.ask_missing(rows, counting(str(log), answer="no json"), path, retries=2) == 30
    assert len(calls(log)) == 60
    assert L.ask_missing(rows, counting(str(log)), path) == 0
    got = L.ledger_answers(rows, path)
    assert got.where("prediction is not null").isEmpty() and got.where(F.col("response") == "no json").count() == 60
