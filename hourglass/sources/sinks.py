"""Panel, parameter, result and embedding stores.

Every sink is a Spark writer (job commit protocol = atomic publish; a failed task is retried, a failed
job leaves no partial output). Only bounded result tables are written to a single file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.exprs import nan_to_null
from hourglass.functions.indexing import file_order_key, global_index
from hourglass.spec import PanelSpec, feature_catalog

PARAMS_SCHEMA = "column string, median double, iqr double"
VALUE_PARAMS_SCHEMA = "column string, is_binary boolean, use_log1p boolean, median double, iqr double"


# ------------------------------------------------------------------ S4 / S5
def read_panel(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Panel Parquet (a missing path fails natively); with a schema the read is not inferred. NaN → NULL."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.select(*[nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def write_panel(df: DataFrame, path: str, spec: PanelSpec | None = None) -> None:
    """Parquet, one directory per split (partition pruning on read)."""
    w = df.write.mode("overwrite")
    if spec is not None and spec.split_col in df.columns:
        w = w.partitionBy(spec.split_col)
    w.parquet(path)


# ------------------------------------------------------------------ S6 / S7 / S8 / S9
def write_params(params: DataFrame, path: str) -> None:
    """Fitted parameters (one row per feature) as one CSV with header."""
    params.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def read_params(spark: SparkSession, path: str, schema: str = PARAMS_SCHEMA) -> DataFrame:
    """S6 reader with an explicit schema."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def variable_map(spark: SparkSession, spec: PanelSpec) -> DataFrame:
    """``(variable, index, ohe_column)`` from the spec."""
    return feature_catalog(spark, spec).select(F.col("feature").alias("variable"), F.col("idx").alias("index"),
                                               "ohe_column")


def write_variable_map(spark: SparkSession, spec: PanelSpec, path: str) -> None:
    vm = variable_map(spark, spec).coalesce(1)
    vm.write.mode("overwrite").json(f"{path}/json")
    vm.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


def write_results(df: DataFrame, path: str) -> None:
    """Leaderboard / history / prediction / comparison tables as CSV with header."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def finite_or_null(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~(F.isnan(c) | c.isin(float("inf"), float("-inf"))), c)


def _finite(c, dt: T.DataType):
    """``c`` with every non-finite double in it, however deep, as null."""
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return finite_or_null(c.cast("double"))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _finite(x, dt.elementType))
    if isinstance(dt, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_finite(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda _, v: _finite(v, dt.valueType))
    return c


def summary_json(df: DataFrame) -> DataFrame:
    """One JSON document per row; non-finite doubles (also in arrays, structs and maps) become null."""
    cols = [_finite(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


MAX_SUMMARY_ROWS = 100_000


def summary_document(values: dict, tables: dict[str, DataFrame], max_rows: int = MAX_SUMMARY_ROWS) -> str:
    """One nested JSON document: ``values`` (any nesting of dicts, lists, texts and numbers) and, under its name,
    each table's rows as objects. Non-finite numbers become null. A table of more than ``max_rows`` rows is an
    error before any of them reaches the driver: a summary is small, data has its own sinks."""
    import json
    import math

    def plain(v):
        if isinstance(v, dict):
            return {str(k): plain(x) for k, x in v.items()}
        if isinstance(v, (list, tuple)):
            return [plain(x) for x in v]
        if hasattr(v, "tolist"):
            return plain(v.tolist())
        return None if isinstance(v, float) and not math.isfinite(v) else v

    doc = plain(values)
    for name, table in tables.items():
        if name in doc:
            raise ValueError(f"{name} is both a value and a table")
        rows = summary_json(table).limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"{name} has more than {max_rows} rows; write it as a table")
        doc[name] = [json.loads(r["json"]) for r in rows]
    return json.dumps(doc, allow_nan=False, ensure_ascii=False, indent=2)


def publish_text(spark: SparkSession, text: str, path: str) -> None:
    """Write ``text`` as the file ``path`` in the store that the path names, at once: a temporary file beside it is
    completed first and renamed over it, so a reader sees the old document or the new one, never a part."""
    import uuid

    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    try:
        out.write(bytearray(text.encode()))
        out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(staged, target, how)
    except Exception:
        fs.delete(staged, False)
        raise


def write_summary_document(spark: SparkSession, path: str, values: dict, tables: dict[str, DataFrame]) -> None:
    """:func:`summary_document`, published at once under ``path``."""
    publish_text(spark, summary_document(values, tables), path)


def write_summary(df: DataFrame, path: str) -> None:
    summary_json(df).coalesce(1).write.mode("overwrite").text(path)


# ------------------------------------------------------------------ S10–S13: embedding store
def write_embeddings(df: DataFrame, path: str, split_col: str = "split") -> None:
    """``(split, id, embedding array<float>, label)`` Parquet, one directory per split."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_embeddings(spark: SparkSession, path: str, id_col: str = "id", id_order: DataFrame | None = None,
                    id_order_col: str | None = None) -> DataFrame:
    """Read an embedding store. Without an id column, ids come from position: the store's row order
    (file name, row index) is matched to ``id_order`` sorted by ``id_order_col`` — only when both have
    the same number of rows, else an error. Without ``id_order`` the position itself becomes the id.
    """
    df = spark.read.parquet(path)
    if id_col in df.columns:
        return df
    keyed = file_order_key(df.select("*", F.col("_metadata.file_name").alias("_f"),
                                     F.col("_metadata.row_index").alias("_r")))
    pos = global_index(keyed, ["_key"], "_pos").drop("_f", "_r", "_key")
    if id_order is None:
        return pos.withColumnRenamed("_pos", id_col)
    n_store, n_ids = pos.count(), id_order.count()
    if n_store != n_ids:
        raise ValueError(f"embedding rows ({n_store}) and ids ({n_ids}) differ; positional alignment refused")
    ids = global_index(id_order.select(F.col(id_order_col or id_col).alias(id_col)), [id_col], "_pos")
    return pos.join(ids, "_pos").drop("_pos")


def manifest(emb: DataFrame, split_col: str = "split", emb_col: str = "embedding", label_col: str = "label",
             id_col: str = "id") -> DataFrame:
    """Per split ``n``, ``dim`` (max width), labelled count and whether ids are stored."""
    return emb.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(emb_col)).alias("dim"),
                                      F.count(label_col).alias("n_labelled")) \
        .withColumn("has_ids", F.lit(id_col in emb.columns))


def write_side_by_side(parts: list[DataFrame], path: str, id_col: str = "id") -> None:
    """Embeddings, labels, statics and cluster assignments stored together — one Parquet row per id
    holding all columns, aligned by key (equi-joins on the id), never by array position."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, id_col, "left")
    out.write.mode("overwrite").parquet(path)
