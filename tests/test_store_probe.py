"""Absent and broken stores are rows, not exceptions."""

import os

import pytest

from hourglass.operators import store_probe as P


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stores")
    emb = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(60)], "vec_id long, embedding array<double>, label int")
    paths = {n: str(root / n) for n in ("good", "cut", "junk", "mixed", "hollow", "absent", "words")}
    for n in ("good", "cut", "junk", "mixed"):
        emb.repartition(3).write.parquet(paths[n])
    first = sorted(p for p in os.listdir(paths["cut"]) if p.endswith(".parquet"))[0]
    whole = open(f"{paths['cut']}/{first}", "rb").read()
    os.remove(f"{paths['cut']}/{first}")
    with open(f"{paths['cut']}/part-a.parquet", "wb") as f:
        f.write(whole[:len(whole) // 2])
    with open(f"{paths['cut']}/part-b.parquet", "wb") as f:  # the footer is there, the data before it is not
        f.write(whole[:4] + whole[-200:] if len(whole) > 400 else b"PAR1")
    with open(f"{paths['junk']}/part-x.parquet", "wb") as f:
        f.write(b"not parquet")
    emb.drop("label").coalesce(1).write.mode("append").parquet(paths["mixed"])
    os.makedirs(paths["hollow"])
    spark.createDataFrame([("a", ["x", "y"], 1)], "vec_id string, embedding array<string>, label int").write.parquet(paths["words"])
    return paths


def test_every_store_has_its_row(spark, stores):
    got = {r.store: r for r in P.probe_stores(spark, stores).collect()}
    assert {n: r.status for n, r in got.items()} == {"good": "OK", "cut": "UNREADABLE", "junk": "UNREADABLE", "mixed": "MIXED",
                                                     "hollow": "EMPTY", "absent": "MISSING", "words": "OK"}
    assert (got["good"].n_files, got["good"].n_rows, got["good"].columns) == (3, 60, ["vec_id", "embedding", "label"])
    assert got["junk"].n_bad_files == 1 and got["junk"].n_rows == 60 and "part-x.parquet" in got["junk"].detail
    assert got["cut"].n_bad_files == 2 and "no such path" in got["absent"].detail


def test_a_single_file_is_a_store(spark, stores):
    file = next(f"{stores['good']}/{p}" for p in os.listdir(stores["good"]) if p.endswith(".parquet"))
    r = P.probe_stores(spark, {"one": file, "scheme": "file:" + file}).collect()
    assert {x.status for x in r} == {"OK"} and {x.n_files for x in r} == {1}


def test_checks_stop_at_what_cannot_be_read(spark, stores):
    got = {(r.store, r.check): r.status for r in P.store_checks(spark, stores, perplexity=30).collect()}
    assert {k: v for k, v in got.items() if k[0] == "absent"} == {("absent", "exists"): "FAIL"}
    for n in ("cut", "junk", "hollow", "mixed"):
        assert {k[1]: v for k, v in got.items() if k[0] == n} == {"exists": "OK", "readable": "FAIL"}
    assert got["good", "finite"] == "OK" and got["good", "uniform_width"] == "OK" and got["good", "columns"] == "OK"
    assert got["words", "numeric"] == "FAIL" and ("words", "finite") not in got
    assert P.store_checks(spark, {"good": stores["good"]}, label_col="none").where("check = 'columns'").first().status == "FAIL"
