"""Source/sink round trips over the bound tables.

Scratch output goes under the session's shared checkpoint folder (``spark.checkpoint.dir``), never a
machine-local temp folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators import grid
from hourglass.session import checkpoint_dir
from hourglass.sources import log_lines, logs, sinks, tables
from hourglass.sources.tables import EVENTS_SPEC

STATIC_MAP = {"acctbal": "acctbal", "building": "building", "nation": "nation"}
MINUTES_PER_DAY = 1440


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for every run, so runs over different inputs, or at the same time, never share files."""
    return f"{checkpoint_dir(spark).rstrip('/')}/hourglass-scratch/{name}-{uuid.uuid4().hex}"


def clock_text(minutes) -> F.Column:
    return F.format_string("%02d:%02d", (minutes / 60).cast("bigint"), F.pmod(minutes, F.lit(60)))


def events_as_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV log per user in the measurement-log format: RecordID and statics at 00:00, then events in
    event order with the elapsed clock ``HH:MM`` (hours may exceed 23); values below 1 written as -1.
    Every 97th event's value is ``nan``. Faults for the quarantine: users of the unlabelled segment get no
    RecordID row, some users a non-numeric static, some an event with a malformed time."""
    ev = tables.table(spark, sf_dir, "events")
    cust = tables.table(spark, sf_dir, "customer")
    minutes = F.floor(tables.elapsed_us("ts", tables.EVENTS_ORIGIN) / F.lit(60_000_000)).cast("bigint")
    val = (F.when(F.col("event_id") % 97 == 0, F.lit("nan")).when(F.col("value") < 1, F.lit("-1"))
           .otherwise(F.col("value").cast("string")))
    ev_rows = ev.select(F.col("user_id").alias("entity"), (F.col("event_id") + 10).alias("ord"),
                        F.concat_ws(",", clock_text(minutes), F.col("event_type"), val).alias("line"))
    users = ev.select(F.col("user_id").alias("entity")).distinct().join(
        cust.select(F.col("c_custkey").alias("entity"), "c_acctbal", "c_mktsegment", "c_nationkey"), "entity", "left")
    stat = users.select("entity", F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("ord"),
                 F.when(F.col("c_mktsegment") != tables.UNLABELLED_SEGMENT,
                        F.concat(F.lit("00:00,RecordID,"), F.col("entity").cast("string"))).alias("line")),
        F.struct(F.lit(1).cast("bigint").alias("ord"),
                 F.concat(F.lit("00:00,acctbal,"), F.when(F.col("entity") % 11 == 5, F.lit("unknown")).otherwise(
                     F.col("c_acctbal").cast("string"))).alias("line")),
        F.struct(F.lit(4).cast("bigint").alias("ord"),
                 F.when(F.col("entity") % 11 == 7, F.lit("noon,click,5")).alias("line")),
        F.struct(F.lit(2).cast("bigint").alias("ord"),
                 F.concat(F.lit("00:00,building,"), (F.col("c_mktsegment") == "BUILDING").cast("int").cast("string"))
                 .alias("line")),
        F.struct(F.lit(3).cast("bigint").alias("ord"),
                 F.concat(F.lit("00:00,nation,"), F.col("c_nationkey").cast("string")).alias("line")),
    )).alias("s")).select("entity", "s.ord", "s.line").where(F.col("line").isNotNull())
    return stat.unionByName(ev_rows)


_WRITTEN: dict = {}


def write_event_logs(spark: SparkSession, sf_dir: str) -> str:
    """Write the per-user logs once per application and scale factor (the inputs are read-only)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = scratch(spark, "event-logs")
        logs.write_logs(events_as_logs(spark, sf_dir), path, "entity")
        _WRITTEN[key] = path
    return _WRITTEN[key]


def raw_log_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 → G1–G13: scan the per-user logs back and build the daily panel (statics from the log)."""
    path = write_event_logs(spark, sf_dir)
    log, _ = log_lines.split_by_faults(log_lines.scan_lines(spark, path), EVENTS_SPEC.dynamic, STATIC_MAP.values())
    spec = EVENTS_SPEC
    g = grid.build_grid(log, spec, MINUTES_PER_DAY, static_map=STATIC_MAP,
                        labels=tables.events_outcomes(spark, sf_dir))
    return tables.with_split(g, spec)


def raw_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: quarantined files, reported by the entity of their directory and the reason."""
    path = write_event_logs(spark, sf_dir)
    _, rej = log_lines.split_by_faults(log_lines.scan_lines(spark, path), EVENTS_SPEC.dynamic, STATIC_MAP.values())
    return rej.select(F.regexp_extract("file", r"entity=(\d+)", 1).cast("bigint").alias("entity"), "reason")


def embedding_store_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 → S13: write the embedding store by split, read it back, summarise per split."""
    emb = tables.table(spark, sf_dir, "embeddings")
    m = F.pmod(F.col("vec_id"), F.lit(4))
    store = emb.select(F.when(m <= 1, "a").when(m == 2, "b").otherwise("c").alias("split"),
                       F.col("vec_id").alias("id"), "embedding", "label")
    path = scratch(spark, "embedding-store")
    sinks.write_embeddings(store, path)
    return sinks.manifest(sinks.read_embeddings(spark, path))


def positional_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store written without ids (rows in id order) re-aligned to ids by position."""
    emb = tables.table(spark, sf_dir, "embeddings")
    path = scratch(spark, "embedding-noid")
    emb.orderBy("vec_id").select("embedding", "label").write.mode("overwrite").parquet(path)
    return sinks.read_embeddings(spark, path, "vec_id", emb.select("vec_id"), "vec_id")


def params_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The train-fitted scaler written as CSV and read back with an explicit schema."""
    from hourglass.plans import panel

    _, _, _, scaler = panel.events_processed(spark, sf_dir)
    path = scratch(spark, "scaler-params")
    sinks.write_params(scaler, path)
    return sinks.read_params(spark, path)


def panel_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forward-filled panel written by split and read back, every split by a pruned read of its own."""
    from hourglass.plans import panel

    path = scratch(spark, "panel-ffill")
    sinks.write_panel(panel.events_ffill(spark, sf_dir), path, EVENTS_SPEC)
    panels = [sinks.read_panel(spark, path).where(F.col("split") == s) for s in ("a", "b", "c")]
    return panels[0].unionByName(panels[1]).unionByName(panels[2])


def stores_with_faults(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The embeddings written as a good store, a path without one, and a copy whose largest file is cut short."""
    emb = tables.table(spark, sf_dir, "embeddings")
    root = scratch(spark, "stores")
    paths = {n: f"{root}/{n}" for n in ("good", "absent", "truncated")}
    for n in ("good", "truncated"):
        emb.write.parquet(paths[n])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(paths["truncated"])
    fs = folder.getFileSystem(conf)
    files = [f for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet")]
    largest = max(files, key=lambda f: (f.getLen(), f.getPath().getName()))
    # a writer that was lost half way: the file begins well and has no footer
    source = fs.open(largest.getPath())
    cut = jvm.org.apache.hadoop.fs.Path(folder, "part-cut.parquet")
    half = jvm.org.apache.commons.io.IOUtils.toByteArray(source, int(largest.getLen() // 2))
    source.close()
    out = fs.create(cut, True)
    out.write(bytearray(half))
    out.close()
    fs.delete(largest.getPath(), False)
    return paths


def store_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probe of the three stores."""
    from hourglass.operators import store_probe

    report = store_probe.probe_stores(spark, stores_with_faults(spark, sf_dir))
    # how many files Spark writes depends on the input's partitions
    return report.select("store", "status", F.when(F.col("status") == "OK", F.col("n_rows")).alias("n_rows"),
                         F.when(F.col("status") == "OK", F.array_join("columns", ",")).alias("columns"), "n_bad_files")


def store_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1–D5 over the three stores: check rows for each, contents where a store can be read."""
    from hourglass.operators import store_probe

    checks = store_probe.store_checks(spark, stores_with_faults(spark, sf_dir))
    return checks.select("store", "check", "status")


def summary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard and its size in one nested document, published twice and read back."""
    from hourglass.plans import evaluation

    board = evaluation.config_board(spark, sf_dir)
    path = f"{scratch(spark, 'summary')}/summary.json"
    sinks.write_summary_document(spark, path, {"state": "started"}, {})
    values = {"run": {"task": "quality", "metrics": ["auroc", "auprc"], "best_so_far": float("-inf")}}
    sinks.write_summary_document(spark, path, values, {"leaderboard": board})
    text = spark.read.text(path, wholetext=True)
    kind = f"run struct<task: string, metrics: array<string>, best_so_far: double>, leaderboard array<{board.schema.simpleString()}>"
    doc = text.select(F.from_json("value", kind).alias("doc"))
    return doc.select(F.explode("doc.leaderboard").alias("r"), "doc").select(
        "r.*", F.col("doc.run.task").alias("task"), F.size("doc.run.metrics").alias("n_metrics"), F.col("doc.run.best_so_far").alias("best_so_far"))


def ledger_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers of a ledger that was filled for half of the prompts, then for all, then once more."""
    from hourglass.operators import answer_ledger, prompts
    from hourglass.plans import evaluation

    blocks = evaluation.events_blocks(spark, sf_dir, "c").where(F.col("label").isNotNull())
    asked = prompts.zero_shot_prompt(blocks, "binary")
    path, client = scratch(spark, "ledger"), prompts.rule_client_factory("binary")
    answer_ledger.ask_missing(asked.where(F.col("label") == 1), client, path)
    answer_ledger.ask_missing(asked, client, path)
    again = answer_ledger.ask_missing(asked, client, path)
    return answer_ledger.ledger_answers(asked, path, "user_id", "label").withColumn("asked_again", F.lit(again).cast("long"))
