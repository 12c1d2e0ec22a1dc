"""Embeddings, clustering and contrastive statistics.

Embeddings are ``array<double>`` columns. Everything that the definition lets us decompose is
computed from per-cluster sufficient statistics (count, vector sum, sum of squared norms) — O(n·k), no
pair enumeration. Batch-wise contrastive statistics (InfoNCE, uniformity, collapse) are defined over
fixed-size batches; each batch (≤ ``batch_size`` rows, a parameter) is one ``applyInPandas`` group and
its B×B similarity matrix stays inside that task's numpy.

Not built (need every pair of points, O(n²)): exact Euclidean silhouette, the exact kNN graph and the
community detection on it. :func:`silhouette` is the squared-Euclidean silhouette (Spark's
``ClusteringEvaluator`` definition), which decomposes exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.indexing import global_index


def as_double_array(c):
    return F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("double"))


def norm(c) -> F.Column:
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x))


def dot(a, b) -> F.Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(c, eps: float = 1e-12) -> F.Column:
    """V4: x / max(‖x‖, eps)."""
    c = as_double_array(c)
    return F.transform(c, lambda x: x / F.greatest(norm(c), F.lit(eps)))


# ------------------------------------------------------------------ V1: supplied encoder
def recency_encoder(strength: float = 2.0):
    """Default encoder: recency-weighted mean over time of a [T, D] sequence (Q6 recency pooling)."""
    def encode(seq):
        x = np.asarray([np.asarray(r, dtype=float) for r in seq])
        if x.ndim != 2 or len(x) == 0:
            return None
        t = np.linspace(0.0, 1.0, len(x)) if len(x) > 1 else np.zeros(1)
        w = np.exp(strength * t)
        w = w / w.sum()
        return (w[:, None] * x).sum(axis=0).tolist()
    return encode


def extract_embeddings(df: DataFrame, id_col: str, seq_col: str = "seq", label_col: str | None = "label",
                       encoder_factory=recency_encoder) -> DataFrame:
    """V1: batch embedding extraction with a supplied encoder (built once per partition by the factory).

    Rows whose encoding fails (``None`` or an exception) are dropped; id and label ride along.
    """
    keep = [id_col] + ([label_col] if label_col else [])
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("embedding", T.ArrayType(T.DoubleType()))])

    def run(batches):
        enc = encoder_factory()
        for pdf in batches:
            out = []
            for seq in pdf[seq_col]:
                try:
                    out.append(enc(seq))
                except Exception:  # noqa: BLE001 - a failed row is dropped, as in the reference
                    out.append(None)
            res = pdf[keep].copy()
            res["embedding"] = out
            yield res[res["embedding"].notna()]

    return df.select(*keep, seq_col).mapInPandas(run, schema)


# ------------------------------------------------------------------ V2 / V3: channel aggregation
def channel_mean(channels: DataFrame, id_col: str, emb_col: str = "embedding",
                 statics: DataFrame | None = None, static_cols: list[str] = ()) -> DataFrame:
    """V2: mean over channels per dimension, then ``concat`` the static values. Input long
    ``(id, var, embedding)``; the per-entity channel count is bounded by the spec.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    e = channels.select(id_col, array_to_vector(as_double_array(emb_col)).alias("x"))
    vec = e.groupBy(id_col).agg(vector_to_array(Summarizer.mean(F.col("x"))).alias("embedding"))
    if statics is not None:
        vec = vec.join(statics, id_col, "left").select(
            id_col, F.concat("embedding", F.array(*[F.col(c).cast("double") for c in static_cols])).alias("embedding"))
    return vec


def channel_weighted(channels: DataFrame, id_col: str, weights: dict, emb_col: str = "embedding",
                     var_col: str = "var", statics: DataFrame | None = None, static_cols: list[str] = ()) -> DataFrame:
    """V3: softmax over the given per-channel weights, weighted sum of channel embeddings, concat statics.

    ``weights`` is a parameter (one number per channel), inlined as a literal map. A channel without a
    weight is an error: leaving it out would break the softmax.
    """
    m = max(weights.values())
    z = sum(math.exp(w - m) for w in weights.values())
    soft = {k: math.exp(w - m) / z for k, w in weights.items()}
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    wmap = F.create_map(*[x for k, v in soft.items() for x in (F.lit(k), F.lit(v))])
    w = F.coalesce(wmap[F.col(var_col)], F.raise_error(F.concat(F.lit("no weight for channel "), F.col(var_col).cast("string"))).cast("double"))
    scaled = F.transform(as_double_array(emb_col), lambda x: x * F.col("_w"))
    e = channels.withColumn("_w", w).select(id_col, array_to_vector(scaled).alias("x"))
    vec = e.groupBy(id_col).agg(vector_to_array(Summarizer.sum(F.col("x"))).alias("embedding"))
    if statics is not None:
        vec = vec.join(statics, id_col, "left").select(
            id_col, F.concat("embedding", F.array(*[F.col(c).cast("double") for c in static_cols])).alias("embedding"))
    return vec


# ------------------------------------------------------------------ V5: K-Means, all restarts in one scan
def _vectors_of(batch) -> np.ndarray:
    """The first column of an Arrow batch (equally wide arrays) as a matrix."""
    import pyarrow as pa

    lists = batch.column(0).cast(pa.list_(pa.float64()))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, rows × centers, never below zero."""
    d = (x * x).sum(1)[:, None] + (centers * centers).sum(1) - 2 * x @ centers.T
    return np.maximum(d, 0.0)


def _per_restart(rows: DataFrame, centers: list[np.ndarray], sums: bool) -> list:
    """One scan for all restarts. With ``sums`` one row per (restart, cluster): rows, cost and vector sum. Without, one
    row per restart: the row drawn with a chance in proportion to its squared distance to the nearest center (its
    place is the least of all E / d², with E exponential from the row's hash)."""
    import pyarrow as pa

    schema = T.StructType([T.StructField("restart", T.IntegerType()), T.StructField("cluster", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("cost", T.DoubleType()),
                           T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(batches):
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors_of(batch)
            key = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
            for r, c in enumerate(centers):
                d = _distances(x, c) if len(c) else np.ones((len(x), 1))
                near = d.argmin(1)
                best = d[np.arange(len(x)), near]
                if sums:
                    n, cost = np.bincount(near, minlength=len(c)), np.bincount(near, best, len(c))
                    one = np.zeros((len(x), len(c)))
                    one[np.arange(len(x)), near] = 1
                    vec = one.T @ x
                    for j in np.flatnonzero(n):
                        t = total.setdefault((r, int(j)), [0, 0.0, np.zeros(x.shape[1])])
                        t[0] += int(n[j])
                        t[1] += float(cost[j])
                        t[2] += vec[j]
                else:
                    place = _exponential(key, r * 1009 + len(c)) / np.where(best > 0, best, np.nan)
                    if np.isnan(place).all():
                        continue
                    i = int(np.nanargmin(place))
                    if (r, 0) not in total or place[i] < total[r, 0][1]:
                        total[r, 0] = [1, float(place[i]), x[i]]
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([total[k][0] for k in keys], pa.int64()), pa.array([total[k][1] for k in keys], pa.float64()),
             pa.array([total[k][2] for k in keys], pa.list_(pa.float64()))], names=schema.names)

    partial = rows.mapInArrow(run, schema)
    if not sums:
        return partial.groupBy("restart").agg(F.min(F.struct("cost", "vector")).alias("b")).select("restart", "b.vector").collect()
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    added = vector_to_array(Summarizer.sum(array_to_vector("vector")))
    return partial.groupBy("restart", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), added.alias("vector")).collect()


def _exponential(key: np.ndarray, draw: int) -> np.ndarray:
    """Exponential numbers that depend on the row key and the draw alone."""
    h = key ^ np.uint64(0x9E3779B97F4A7C15 * (draw + 1) % (1 << 64))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    u = ((h >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
    return -np.log(u)


def kmeans_fits(df: DataFrame, emb_col: str = "embedding", k: int = 2, n_init: int = 10, seed: int = 42, max_iter: int = 300,
                tol: float = 1e-4) -> list[tuple[float, np.ndarray]]:
    """``(cost, centers)`` of every restart. Start and every iteration are one scan for all restarts: the centers of
    all that still move travel with the tasks, and one aggregate of restarts × k rows updates them.

    A restart starts from k rows drawn one after another with a chance in proportion to the squared distance to the
    nearest center so far (k-means++ over all rows), by hashes of (row, seed, restart, draw), so a run of several
    restarts and a run of one give the same fit. It stops when no center moves farther than ``tol``; an empty cluster
    keeps its center; fewer different rows than ``k`` give fewer centers."""
    from hourglass.session import reuse

    keys = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    rows = reuse(df.select(as_double_array(emb_col).alias("x"), F.xxhash64(F.lit(seed), *keys).alias("key")).where("x is not null"))
    try:
        centers: list[np.ndarray] = [np.zeros((0, 0)) for _ in range(n_init)]
        for _ in range(k):
            for r in _per_restart(rows, centers, sums=False):
                old, new = centers[r["restart"]], np.array([r["vector"]])
                centers[r["restart"]] = np.concatenate((old, new)) if len(old) else new
        if not len(centers[0]):
            return []
        moving, fits = list(range(n_init)), [(float("inf"), c) for c in centers]
        for i in range(max_iter + 1):
            found = _per_restart(rows, [centers[r] for r in moving], sums=True)
            cost, after = {}, {r: centers[r].copy() for r in moving}
            for f in found:
                r = moving[f["restart"]]
                cost[r] = cost.get(r, 0.0) + f["cost"]
                after[r][f["cluster"]] = np.asarray(f["vector"]) / f["n"]
            still = []
            for r in moving:
                fits[r] = (cost[r], centers[r])
                if i < max_iter and np.sqrt(((after[r] - centers[r]) ** 2).sum(1)).max() > tol:
                    centers[r] = after[r]
                    still.append(r)
            moving = still
            if not moving:
                break
        return fits
    finally:
        rows.unpersist()


def kmeans_restarts(df: DataFrame, emb_col: str = "embedding", k: int = 2, n_init: int = 10, seed: int = 42,
                    max_iter: int = 300) -> DataFrame:
    """V5: K-Means with ``n_init`` seeded restarts that share their scans (:func:`kmeans_fits`); the one with the lowest
    cost counts (ties: the earliest). Adds ``cluster`` (int, the nearest center; null for a null embedding)."""
    fits = kmeans_fits(df, emb_col, k, n_init, seed, max_iter)
    centers = min(fits, key=lambda f: round(f[0], 9))[1] if fits else np.zeros((1, 1))
    x = as_double_array(emb_col)
    # at most k centers, a parameter: nearest by |c|^2 - 2 x.c
    score = [F.lit(float(c @ c)) - 2 * dot(x, F.array(*[F.lit(float(v)) for v in c])) for c in centers]
    place = F.array_position(F.array(*score), F.array_min(F.array(*score))) - 1
    return df.withColumn("cluster", F.when(F.col(emb_col).isNotNull(), place).cast("int"))


# ------------------------------------------------------------------ V15: Spark ML
def pca_2d(df: DataFrame, emb_col: str = "embedding", k: int = 2) -> DataFrame:
    """K-dimensional PCA projection (the t-SNE initialiser); each component's sign is fixed so its
    largest-magnitude loading is positive."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = df.withColumn("_vec", array_to_vector(as_double_array(emb_col)))
    model = PCA(k=k, inputCol="_vec", outputCol="_pc").fit(v)
    comps = model.pc.toArray()  # D × k, bounded by the embedding width
    signs = [1.0 if comps[np.argmax(np.abs(comps[:, j])), j] >= 0 else -1.0 for j in range(k)]
    proj = vector_to_array(F.col("_pc"))
    return model.transform(v).drop("_vec").withColumn(
        "projection", F.array(*[proj[j] * F.lit(signs[j]) for j in range(k)])).drop("_pc")


def random_projection(df: DataFrame, dim: int, emb_col: str = "embedding", seed: int = 42, k: int = 2) -> DataFrame:
    """Seeded Gaussian ``dim × k`` projection (a parameter matrix, inlined) as a 2-D baseline."""
    w = projection_weights(dim, seed, k)
    e = as_double_array(emb_col)
    return df.withColumn("projection", F.array(*[dot(e, F.array(*[F.lit(float(x)) for x in w[:, j]]))
                                                 for j in range(k)]))


def projection_weights(dim: int, seed: int = 42, k: int = 2) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, k))


# ------------------------------------------------------------------ V6–V10: clustering quality
def cluster_stats(df: DataFrame, emb_col: str, label_col: str) -> DataFrame:
    """Per cluster: count, vector sum, Σ‖x‖² (sufficient statistics, partial aggregation)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    e = df.select(F.col(label_col).alias("c"), as_double_array(emb_col).alias("x"))
    return e.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum(dot(F.col("x"), F.col("x"))).alias("sq"),
                              vector_to_array(Summarizer.sum(array_to_vector("x"))).alias("sum"))


def bounded_rows(df: DataFrame, most: int) -> list:
    """The rows of a table that must be small; the bound holds before anything reaches the driver."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} clusters; raise max_clusters if so many are meant")
    return rows


def silhouette(df: DataFrame, emb_col: str, label_col: str, max_clusters: int = 500) -> DataFrame:
    """V6 (squared Euclidean): mean over points of (b − a) / max(a, b); a point alone in its cluster scores 0.

    ``mean_j ‖x − x_j‖² = ‖x‖² − 2 x·μ_C + Σ‖x_j‖²/|C|`` from the per-cluster statistics (k rows,
    checked ≤ ``max_clusters``) — exact, linear in n.
    """
    st = cluster_stats(df, emb_col, label_col)
    rows = bounded_rows(st, max_clusters)
    stats = F.array(*[F.struct(F.lit(r["c"]).alias("c"), F.lit(int(r["n"])).alias("n"),
                               F.lit(float(r["sq"])).alias("sq"),
                               F.array(*[F.lit(float(v)) for v in r["sum"]]).alias("sum")) for r in rows])
    # materialise the per-row vectors once: interpreted lambdas would otherwise be re-evaluated per use
    base = df.select(F.col(label_col).alias("_c"), as_double_array(emb_col).alias("_x"))
    base = base.select("_c", "_x", dot(F.col("_x"), F.col("_x")).alias("_xx"))
    # total squared distance to every member of each cluster
    tot = F.transform(stats, lambda s: F.struct(
        s["c"].alias("c"), s["n"].alias("n"),
        (s["n"].cast("double") * F.col("_xx") - F.lit(2.0) * dot(F.col("_x"), s["sum"]) + s["sq"]).alias("t")))
    base = base.select("_c", tot.alias("_tot"))
    own = F.filter(F.col("_tot"), lambda s: s["c"] == F.col("_c"))[0]
    base = base.select("_tot", "_c", own["n"].alias("_on"), own["t"].alias("_ot"))
    a = F.when(F.col("_on") > 1, F.col("_ot") / (F.col("_on") - 1).cast("double"))
    others = F.filter(F.col("_tot"), lambda s: s["c"] != F.col("_c"))
    b = F.array_min(F.transform(others, lambda s: s["t"] / s["n"].cast("double")))
    base = base.select(a.alias("_a"), b.alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    sil = F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(
        F.when(F.greatest(a, b) > 0, (b - a) / F.greatest(a, b)).otherwise(F.lit(0.0)))
    return base.select(sil.alias("s")).agg(F.avg("s").alias("silhouette"))


def davies_bouldin(df: DataFrame, emb_col: str, label_col: str, max_clusters: int = 500) -> DataFrame:
    """V7: mean over clusters of max_j (s_i + s_j) / ‖c_i − c_j‖, s = mean distance to the centroid.

    Centroids come from one aggregation (k rows, bounded); scatters from a second pass with the centroids
    inlined; the k × k ratio table is computed from those k rows.
    """
    st = bounded_rows(cluster_stats(df, emb_col, label_col), max_clusters)
    cent = {r["c"]: np.asarray(r["sum"], dtype=float) / r["n"] for r in st}
    cmap = F.create_map(*[x for k, v in cent.items() for x in (F.lit(k), F.array(*[F.lit(float(u)) for u in v]))])
    x = as_double_array(emb_col)
    c = cmap[F.col(label_col)]
    dist = F.sqrt(F.aggregate(F.zip_with(x, c, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda acc, v: acc + v))
    sc = {r[0]: r[1] for r in df.groupBy(label_col).agg(F.avg(dist)).collect()}
    keys = sorted(cent)
    spark = df.sparkSession
    if len(keys) < 2:
        return spark.createDataFrame([(None,)], "davies_bouldin double")
    ratios = []
    for i in keys:
        best = max((sc[i] + sc[j]) / np.linalg.norm(cent[i] - cent[j]) for j in keys if j != i)
        ratios.append(best)
    return spark.createDataFrame([(float(np.mean(ratios)),)], "davies_bouldin double")


def contingency_scores(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index, NMI (arithmetic mean of entropies) and cluster counts.

    One pass over the contingency table ``(a, b, n_ij)`` with its marginals attached (equi-joins on a
    and on b); marginal sums are taken per contingency row with weight n_ij / a_i (Σ_j n_ij = a_i).
    """
    ct = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("nij"))
    ra = ct.groupBy(a).agg(F.sum("nij").alias("ai"))
    rb = ct.groupBy(b).agg(F.sum("nij").alias("bj"))
    jn = ct.join(ra, a).join(rb, b)
    nij, ai, bj = (F.col(c).cast("double") for c in ("nij", "ai", "bj"))
    c2 = lambda x: x * (x - 1) / 2.0
    agg = jn.agg(F.sum(nij).alias("n"), F.sum(c2(nij)).alias("sij"),
                 F.sum(c2(ai) * nij / ai).alias("sa"), F.sum(c2(bj) * nij / bj).alias("sb"),
                 F.sum(nij * F.log(nij)).alias("t1"), F.sum(nij * F.log(ai)).alias("ta"),
                 F.sum(nij * F.log(bj)).alias("tb"),
                 F.countDistinct(a).alias("n_clusters_a"), F.countDistinct(b).alias("n_clusters_b"))
    n = F.col("n")
    expected = F.col("sa") * F.col("sb") / (n * (n - 1) / 2.0)
    mx = (F.col("sa") + F.col("sb")) / 2.0
    ari = F.when(mx == expected, F.lit(1.0)).otherwise((F.col("sij") - expected) / (mx - expected))
    # MI = Σ p_ij ln(n·n_ij / (a_i·b_j)); H_a = ln n − Σ a_i ln a_i / n
    mi = (F.col("t1") - F.col("ta") - F.col("tb")) / n + F.log(n)
    h_a = F.log(n) - F.col("ta") / n
    h_b = F.log(n) - F.col("tb") / n
    nmi = F.when((h_a == 0) & (h_b == 0), F.lit(1.0)).otherwise(
        F.when((h_a == 0) | (h_b == 0), F.lit(0.0)).otherwise(mi / ((h_a + h_b) / 2.0)))
    return agg.select(ari.alias("ari"), nmi.alias("nmi"), "n_clusters_a", "n_clusters_b")


def clustering_report(df: DataFrame, emb_col: str, label_col: str, k: int = 2, n_init: int = 10,
                      seed: int = 42) -> DataFrame:
    """One row — silhouette (V6) and Davies–Bouldin (V7) of the true labels, then K-Means (V5) scored
    against the labels with ARI / NMI / cluster counts (V8–V10) and its own silhouette."""
    sil_true = silhouette(df, emb_col, label_col).first()["silhouette"]
    db_true = davies_bouldin(df, emb_col, label_col).first()["davies_bouldin"]
    km = kmeans_restarts(df, emb_col, k=k, n_init=n_init, seed=seed)
    sil_km = silhouette(km, emb_col, "cluster").first()["silhouette"]
    return contingency_scores(km, label_col, "cluster").select(
        F.lit(sil_true).alias("silhouette_labels"), F.lit(db_true).alias("davies_bouldin_labels"),
        F.col("ari").alias("kmeans_ari"), F.col("nmi").alias("kmeans_nmi"),
        F.col("n_clusters_a").alias("n_label_classes"), F.col("n_clusters_b").alias("n_kmeans_clusters"),
        F.lit(sil_km).alias("silhouette_kmeans"))


# ------------------------------------------------------------------ V16–V20: contrastive statistics
def assign_batches(df: DataFrame, order_col: str, batch_size: int) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in ``order_col`` order (last partial batch kept)."""
    return global_index(df, [order_col], "pos").withColumn(
        "batch_id", F.floor(F.col("pos") / F.lit(batch_size)).cast("bigint"))


BATCH_SCHEMA = "batch_id long, n long, infonce double, alignment double, uniformity double, collapse double"


def batch_statistics(df: DataFrame, z1: str, z2: str, tau: float = 0.1) -> DataFrame:
    """V16, V18–V20 per batch: symmetric InfoNCE ½(CE(z1·z2ᵀ/τ) + CE(transposed)), alignment mean ‖z1−z2‖²,
    uniformity log mean exp(−2‖z1_i − z1_j‖²) over all ordered pairs (i = j included), collapse = mean
    cosine over i ≠ j. Input rows carry ``batch_id``; each group is one batch (≤ batch size rows).
    """
    def per_batch(key, pdf):
        a = np.stack([np.asarray(v, dtype=float) for v in pdf[z1]])
        b = np.stack([np.asarray(v, dtype=float) for v in pdf[z2]])
        n = len(a)
        logits = a @ b.T / tau

        def ce(m):
            mx = m.max(axis=1, keepdims=True)
            lse = (mx[:, 0] + np.log(np.exp(m - mx).sum(axis=1)))
            return float(np.mean(lse - np.diag(m)))

        loss = 0.5 * (ce(logits) + ce(logits.T))
        align = float(np.mean(((a - b) ** 2).sum(axis=1)))
        sq = (a * a).sum(axis=1)
        d2 = np.maximum(sq[:, None] + sq[None, :] - 2 * a @ a.T, 0.0)
        np.fill_diagonal(d2, 0.0)
        unif = float(np.log(np.mean(np.exp(-2.0 * d2))))
        cos = a @ a.T
        coll = float((cos.sum() - np.trace(cos)) / (n * (n - 1))) if n > 1 else float("nan")
        return pd.DataFrame({"batch_id": [int(key[0])], "n": [n], "infonce": [loss], "alignment": [align],
                             "uniformity": [unif], "collapse": [coll]})

    return df.select("batch_id", z1, z2).groupBy("batch_id").applyInPandas(per_batch, BATCH_SCHEMA)


def dataset_contrastive(batches: DataFrame) -> DataFrame:
    """V17 + epoch averages: InfoNCE mean over batches with ≥ 2 rows; alignment, uniformity and collapse
    averaged over batches (collapse over batches with ≥ 2 rows)."""
    big = F.col("n") >= 2
    return batches.agg(F.avg(F.when(big, F.col("infonce"))).alias("infonce"), F.avg("alignment").alias("alignment"),
                       F.avg("uniformity").alias("uniformity"), F.avg(F.when(big, F.col("collapse"))).alias("collapse"),
                       F.count(F.lit(1)).alias("n_batches"))
