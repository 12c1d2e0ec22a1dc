"""Distributed primitives against direct numpy computations (random data with ties and groups)."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.functions.cumulative import running_sums
from hourglass.functions.indexing import global_index
from hourglass.functions.quantiles import exact_quantiles, quantile_row


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    want = np.percentile(np.asarray(xs, dtype=float), [0, 25, 50, 75, 100])
    got = quantile_row(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0])["x"]
    assert np.allclose(got, want)


def test_partition_count_does_not_matter(spark):
    rng = np.random.default_rng(5)
    rows = [(float(v), int(k)) for v, k in zip(rng.integers(0, 200, 777), rng.permutation(777))]
    df = spark.createDataFrame(rows, "x double, k long")
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append((quantile_row(df, ["x"], [0.1, 0.5, 0.99]), sorted(map(tuple, running_sums(df, [], "k", ["x"]).collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_grouped_quantiles(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 4, 400), rng.integers(0, 30, 400))]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r["g"]: (r["q_0"], r["q_1"]) for r in exact_quantiles(df, ["x"], [0.3, 0.9], ["g"]).collect()}
    for g in range(4):
        xs = np.asarray([v for k, v in rows if k == g])
        assert np.allclose(got[g], np.percentile(xs, [30, 90]))


def test_running_sums_match_cumsum(spark):
    rng = np.random.default_rng(1)
    keys = rng.permutation(500)
    rows = [(int(k % 3), float(k), int(v)) for k, v in zip(keys, rng.integers(0, 9, 500))]
    df = spark.createDataFrame(rows, "g int, k double, v long").repartition(7)
    out = running_sums(df, ["g"], "k", ["v"], buckets=5).collect()
    small = running_sums(df, ["g"], "k", ["v"], buckets=1).collect()
    assert sorted(out) == sorted(small)
    for g in range(3):
        mine = sorted((r["k"], r["v"], r["cum_v"]) for r in out if r["g"] == g)
        assert [c for _, _, c in mine] == list(np.cumsum([v for _, v, _ in mine]))


def test_global_index_consecutive(spark):
    ids = np.random.default_rng(2).permutation(1000)[:300]
    df = spark.createDataFrame([(int(i),) for i in ids], "id long").repartition(9)
    out = sorted((r["id"], r["pos"]) for r in global_index(df, ["id"]).collect())
    assert [p for _, p in out] == list(range(300))


def test_positional_alignment_requires_equal_counts(spark, tmp_path):
    from hourglass.sources import sinks

    spark.createDataFrame([([1.0],), ([2.0],)], "embedding array<double>").coalesce(1) \
        .write.mode("overwrite").parquet(str(tmp_path / "e"))
    ids = spark.createDataFrame([(10,), (11,), (12,)], "id long")
    with pytest.raises(ValueError):
        sinks.read_embeddings(spark, str(tmp_path / "e"), "id", ids, "id")
    ok = sinks.read_embeddings(spark, str(tmp_path / "e"), "id", ids.where("id < 12"), "id").collect()
    assert sorted((r["id"], r["embedding"][0]) for r in ok) == [(10, 1.0), (11, 2.0)]
