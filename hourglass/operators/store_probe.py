"""What is there in stores that may be absent or broken, as rows instead of exceptions.

A store is a file or a folder of Parquet files. Its files are listed by Spark (names and lengths, no contents) and
tasks read each file's footer alone: whether it is Parquet at all, its rows, its columns and whether its last byte is
where the footer says. Nothing in a broken file fails the job; a store without its path, without files or with a bad
file is a row that says so. The contents of a sound store are then checked by :func:`quality.embedding_checks`.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.quality import NUMERIC_ELEMS, embedding_checks

FILES = "store string, path string, bytes long, readable boolean, n_rows long, columns array<string>, detail string"
REPORT = "store string, status string, n_files long, n_bad_files long, n_rows long, columns array<string>, detail string"
CHECKS = "store string, check string, status string, detail string"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _footer(path: str) -> tuple[bool, int | None, list[str] | None, str]:
    """Readable, rows, columns and a text of one file, from its footer."""
    import re

    import pyarrow.parquet as pq
    from pyarrow import fs

    try:
        store, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        with store.open_input_file(inner) as source:
            file = pq.ParquetFile(source)
            meta, size = file.metadata, source.size()
            ends = [c.file_offset if c.total_compressed_size is None else
                    min(o for o in (c.data_page_offset, c.dictionary_page_offset) if o is not None) + c.total_compressed_size
                    for g in range(meta.num_row_groups) for c in (meta.row_group(g).column(i) for i in range(meta.num_columns))]
            if ends and max(ends) > size:
                return False, None, None, f"data ends at byte {max(ends)} of {size}"
            return True, meta.num_rows, list(file.schema_arrow.names), ""
    except Exception as e:  # noqa: BLE001 - whatever is wrong with a file is its row's detail
        return False, None, None, f"{type(e).__name__}: {e}".splitlines()[0][:200]


def probe_files(spark: SparkSession, store: str, path: str) -> DataFrame:
    """``FILES``: one row per file of a store that exists; hidden files (``_`` and ``.``) are none of its files."""

    def run(batches):
        for pdf in batches:
            found = [_footer(p) for p in pdf["path"]]
            yield pd.DataFrame({"store": store, "path": pdf["path"], "bytes": pdf["bytes"],
                                **{c: pd.Series([f[i] for f in found], dtype=t) for i, (c, t) in enumerate(
                                    (("readable", bool), ("n_rows", "Int64"), ("columns", object), ("detail", object)))}})

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))
    return listed.mapInPandas(run, FILES)


def probe_stores(spark: SparkSession, stores: dict[str, str]) -> DataFrame:
    """``REPORT``: one row per store: OK, MISSING (no such path), EMPTY (no file with a byte in it), UNREADABLE (a file
    without a sound footer; ``n_rows`` counts the others) or MIXED (files with different columns)."""
    absent = [(n, "MISSING", 0, 0, None, None, f"no such path: {p}") for n, p in stores.items() if not exists(spark, p)]
    gone = {a[0] for a in absent}
    rows = spark.createDataFrame(absent, REPORT)
    there = {n: p for n, p in stores.items() if n not in gone}
    if not there:
        return rows
    files = reduce(DataFrame.unionByName, [probe_files(spark, n, p) for n, p in there.items()])
    bad = ~F.col("readable")
    seen = files.groupBy("store").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum(bad.cast("long")).alias("n_bad_files"), F.sum("n_rows").alias("n_rows"),
        F.min("columns").alias("columns"), F.max("columns").alias("_last"),
        F.min(F.when(bad, F.concat_ws(": ", F.element_at(F.split("path", "/"), -1), "detail"))).alias("detail"))
    names = spark.createDataFrame([(n,) for n in there], "store string")
    met = names.join(seen, "store", "left")
    status = (F.when(F.col("n_files").isNull(), "EMPTY").when(F.col("n_bad_files") > 0, "UNREADABLE")
              .when(~F.col("columns").eqNullSafe(F.col("_last")), "MIXED").otherwise("OK"))
    whole = met.select("store", status.alias("status"), F.coalesce("n_files", F.lit(0)).alias("n_files"),
                       F.coalesce("n_bad_files", F.lit(0)).alias("n_bad_files"), "n_rows", "columns",
                       F.coalesce("detail", F.lit("")).alias("detail"))
    return rows.unionByName(whole)


def store_checks(spark: SparkSession, stores: dict[str, str], emb_col: str = "embedding", label_col: str = "label",
                 k_clusters: int = 2, perplexity: int = 30) -> DataFrame:
    """``CHECKS`` (D1–D5) of every store: ``exists``, ``readable`` and ``columns`` from the probe, then the checks of its
    contents where the probe is OK. A store that cannot be read has FAIL rows and stops no other."""
    out = []
    for r in probe_stores(spark, stores).collect():  # one row per store
        ok = r.status == "OK"
        out.append((r.store, "exists", "FAIL" if r.status == "MISSING" else "OK", r.detail if r.status == "MISSING" else ""))
        if r.status == "MISSING":
            continue
        out.append((r.store, "readable", "OK" if ok else "FAIL", f"{r.status}: {r.n_bad_files} of {r.n_files} files" + (f"; {r.detail}" if r.detail else "")))
        lacking = [c for c in (emb_col, label_col) if ok and c not in r.columns]
        if ok:
            out.append((r.store, "columns", "FAIL" if lacking else "OK", ",".join(lacking)))
        stores = {**stores, r.store: stores[r.store] if ok and not lacking else None}
    rows = spark.createDataFrame(out, CHECKS)
    sound = [n for n, p in stores.items() if p is not None and (n, "columns", "OK", "") in out]
    for n in sound:
        emb = spark.read.parquet(stores[n])
        elem = getattr(emb.schema[emb_col].dataType, "elementType", None)
        if isinstance(elem, NUMERIC_ELEMS):
            found = embedding_checks(emb, emb_col, label_col, k_clusters, perplexity)
        else:  # without numbers the other checks have no meaning
            found = spark.createDataFrame([("numeric", "FAIL", emb.schema[emb_col].dataType.simpleString())], "check string, status string, detail string")
        rows = rows.unionByName(found.select(F.lit(n).alias("store"), "check", "status", "detail"))
    return rows
