"""Fits and log files are dealt by what they cost, not by the partitions that the input came in."""

import os
import re

from pyspark.sql import functions as F
from test_boosting import NAMES, SCHEMA, rows_of

from hourglass.plans import models
from hourglass.sources import log_lines, logs


def test_forests_score_one_by_one_over_few_partitions(spark):
    t = spark.createDataFrame(rows_of(n=300, missing=0.0), SCHEMA).na.fill(0.0).withColumn(
        "split", F.when(F.col("id") % 4 <= 1, "a").when(F.col("id") % 4 == 2, "b").otherwise("c")).repartition(24)
    grid = ({"n_estimators": 5, "max_depth": None, "min_samples_leaf": 1, "class_weight": None},
            {"n_estimators": 5, "max_depth": 3, "min_samples_leaf": 5, "class_weight": "balanced"})
    scored = models._fitted(t, NAMES, "rf", grid, "id", "split", "a", ("b", "c"), "label", 8)
    assert scored.rdd.getNumPartitions() == 2 and scored.count() == 2 * 150
    # the models are not part of the plan any more
    assert "UDF" not in scored._jdf.queryExecution().toString()
    board = {r.cfg_idx: r for r in models.sweep(t, NAMES, "rf", grid, "id").collect()}
    assert set(board) == {0, 1} and all(r.val_auroc > 0.7 and r.test_auroc > 0.7 for r in board.values())


def test_large_forests_are_grown_one_after_the_other():
    assert models._at_once(models.RF_GRID, 750, 8) == 8
    assert models._at_once(models.RF_GRID, 100_000, 8) == 1
    assert models._at_once(models.LR_GRID, 10**9, 8) == 8


def test_many_log_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 90).select(F.col("id").alias("entity"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("ord"))
    lines = rows.withColumn("line", F.when(F.col("ord") == 0, F.concat(F.lit("00:00,RecordID,"), F.col("entity").cast("string")))
                            .otherwise(F.concat(F.lit("01:00,HR,"), F.col("ord").cast("string"))))
    monkeypatch.setattr(logs, "FILES_PER_TASK", 10)
    path = str(tmp_path / "logs")
    logs.write_logs(lines, path)
    names = [f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
    assert len(names) == 90 and len({re.match(r"part-(\d+)", f).group(1) for f in names}) > 4
    log, rejects = log_lines.split_by_faults(log_lines.scan_lines(spark, path), ("HR",))
    assert rejects.isEmpty() and log.count() == 270
    last = log.where("parameter = 'HR'").groupBy("id").agg(F.max_by("value", "ord").alias("v")).select("v").distinct().collect()
    assert [r.v for r in last] == ["2"]
