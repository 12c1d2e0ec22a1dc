"""A ledger of model answers, so that no prompt is asked twice.

Answers are keyed by a hash of mode and prompt in an append-only folder. A run asks for the distinct prompts that the
ledger has no answer to (an anti-join), each task with at most ``in_flight`` calls at a time, and a task saves its
answers every ``chunk`` prompts. A repeated run asks for nothing that is answered; a task that is run again (a lost
executor, a failure) first reads what its earlier attempts saved, so at most the calls of one unsaved chunk are
repeated. Prompts are dealt to tasks by their key, so a rerun task meets the same prompts.

Defined results: equal prompts are asked once; a prompt whose calls all fail has a null answer and is asked again by
the next run; an answer that does not parse is kept (it was tried ``retries`` times) and yields a null prediction;
a null prompt is not asked.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.prompts import ask, parse_binary, parse_scale

LEDGER = "key string, mode string, response string"


def prompt_key(mode: str) -> F.Column:
    return F.sha2(F.concat(F.lit(f"{mode}\n"), F.col("prompt")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All saved answers; an empty table before the first run. Files in the making are hidden by their name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(path)


def _store(path: str):
    """The Arrow file system and path of a folder, in tasks."""
    import re

    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^(?:file:/*)?/", "file:///", path))


def _answers_of(folder: str) -> dict[str, str]:
    """What earlier attempts of this task saved."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, root = _store(folder)
    files = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    out: dict[str, str] = {}
    for f in files:
        if f.path.endswith(".parquet") and not f.base_name.startswith("."):
            with store.open_input_file(f.path) as source:
                table = pq.read_table(source)
            out |= dict(zip(table["key"].to_pylist(), table["response"].to_pylist(), strict=True))
    return out


def _save(folder: str, mode: str, answers: list[tuple[str, str]]) -> None:
    """One more file of answers; readers see it when it is complete."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    name = uuid.uuid4().hex
    table = pa.table({"key": [k for k, _ in answers], "mode": [mode] * len(answers), "response": [r for _, r in answers]})
    with store.open_output_stream(f"{root}/.{name}") as sink:
        pq.write_table(table, sink)
    store.move(f"{root}/.{name}", f"{root}/{name}.parquet")


def ask_missing(prompts: DataFrame, client_factory: Callable[[], Callable[[str], str]], path: str, mode: str = "binary",
                retries: int = 3, in_flight: int = 4, chunk: int = 64, tasks: int | None = None) -> int:
    """Ask for every prompt without an answer in the ledger ``path``; the number of prompts asked and answered now.

    ``tasks`` bounds the calls in flight over the cluster (``tasks`` × ``in_flight``); Spark's shuffle partitions
    without it."""
    spark = prompts.sparkSession
    wanted = prompts.where(F.col("prompt").isNotNull()).select(prompt_key(mode).alias("key"), "prompt").dropDuplicates(["key"])
    missing = wanted.join(read_ledger(spark, path).select("key"), "key", "left_anti")
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = f"{path.rstrip('/')}/run-{uuid.uuid4().hex}"

    def work(batches):
        from concurrent.futures import ThreadPoolExecutor

        from pyspark import TaskContext

        folder = f"{run}/task-{TaskContext.get().partitionId()}"
        saved, client, n_asked = _answers_of(folder), None, 0
        with ThreadPoolExecutor(max_workers=in_flight) as pool:
            for pdf in batches:
                rows = [(k, p) for k, p in zip(pdf["key"], pdf["prompt"], strict=True) if k not in saved]
                for i in range(0, len(rows), chunk):
                    part = rows[i:i + chunk]
                    client = client or client_factory()
                    texts = list(pool.map(lambda r: ask(client, r[1], mode, retries), part))
                    done = [(k, t) for (k, _), t in zip(part, texts, strict=True) if t is not None]
                    if done:
                        _save(folder, mode, done)
                    n_asked += len(done)
        yield pd.DataFrame({"n": [n_asked]})

    asked = missing.repartition(n, "key").mapInPandas(work, "n long")
    return int(asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def ledger_answers(prompts: DataFrame, path: str, id_col: str = "id", label_col: str | None = "label", mode: str = "binary") -> DataFrame:
    """Every row of ``prompts`` with the ledger's ``response`` (null without one) and its ``prediction``."""
    parse = parse_binary if mode == "binary" else parse_scale
    # a rerun while its first attempt is still alive may save a prompt twice: one answer counts
    saved = (read_ledger(prompts.sparkSession, path).where(F.col("mode") == mode)
             .groupBy("key").agg(F.min("response").alias("response")))
    keep = [id_col] + ([label_col] if label_col else [])
    met = prompts.withColumn("key", prompt_key(mode)).join(saved, "key", "left")
    return met.select(*keep, "response").withColumn("prediction", parse(F.col("response")))


def call_with_ledger(prompts: DataFrame, client_factory, path: str, id_col: str = "id", label_col: str | None = "label",
                     mode: str = "binary", **how) -> DataFrame:
    """L8 through the ledger: ask what is missing, then the answers of all rows."""
    ask_missing(prompts, client_factory, path, mode, **how)
    return ledger_answers(prompts, path, id_col, label_col, mode)
