"""Session helpers: one place for the SQL settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "hourglass") -> SparkSession:
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Settings every operator assumes (UTC wall clock for timestamp_ntz arithmetic), and the package
    shipped to the Python workers that run the pandas hooks."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``hourglass`` importable in Python workers (``addPyFile`` of a zip built once per
    SparkContext), so it works however the driver loaded it — like ``spark-submit --py-files``."""
    import os
    import zipfile

    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # noqa: BLE001 - no JVM context (e.g. a remote client): nothing to ship
        return
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    # a code artifact on the driver that Spark itself distributes to executors (like --py-files)
    out = os.path.join(tempfile.mkdtemp(prefix="hourglass-pyfiles-"), "hourglass.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when a session on a local master names none (tests) a private folder is created and registered; elsewhere
    executors would not share it, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hourglass-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments refuse runtime core settings
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan (from file sizes and statistics; no job is run)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - Spark Connect has no JVM handle
        return 1 << 62


def small_side(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the join strategy to AQE."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def reuse(df: DataFrame) -> DataFrame:
    """Keep a plan that several fits read (memory, spilling to disk); lost blocks are recomputed from
    lineage, so an executor loss costs time, not correctness."""
    from pyspark import StorageLevel

    return df.persist(StorageLevel.MEMORY_AND_DISK)
