"""Operators 1 and 7: recovery of known parameters, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from hourglass.llm import queries, toxicity, weak_quality

SF = "/root/testdata/sf0.01"


def auc(scores, truth):
    rank = np.empty(len(scores))
    rank[np.argsort(scores, kind="stable")] = np.arange(1, len(scores) + 1)
    p = truth.sum()
    return (rank[truth == 1].sum() - p * (p + 1) / 2) / (p * (len(truth) - p))


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_vote_model_recovers_accuracies():
    pick = np.random.default_rng(2)
    truth = pick.random(40_000) < 0.8
    accuracy = np.linspace(0.7, 0.97, len(weak_quality.LABELLERS))
    right = pick.random((len(truth), len(accuracy))) < accuracy
    votes = np.where(pick.random(right.shape) < 0.2, weak_quality.NONE, np.where(right, truth[:, None], ~truth[:, None]))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak_quality.VoteModel(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.02
    assert np.abs(np.array(list(model.accuracies().values())) - accuracy).max() < 0.02
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.97


def test_weak_quality_query(spark, labels, texts):
    rows = {r.doc_id: r for r in queries.op1_weak_quality(spark, SF).collect()}
    assert len(rows) == len(texts)
    truth = np.array([x.quality for x in labels.values()])
    kept = np.array([rows[i].kept for i in labels])
    assert kept[truth == 1].mean() > 0.98 and (~kept[truth == 0]).mean() > 0.9
    r = next(iter(rows.values()))
    assert 0 <= r.score <= 1 and 0 <= r.posterior <= 1


def test_weak_quality_odd_rows(spark, odd_documents):
    rows = weak_quality.weak_quality(odd_documents, fit_rows=100).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.n_votes, r.posterior, r.score))
    assert len(rows) == 11 and by[2] == by[3] == by[4] and len(by[1]) == 1 and by[1] == by[9]
    assert next(iter(by[2]))[0] == 0
    assert weak_quality.weak_quality(odd_documents.limit(0)).count() == 0


def test_toxicity_query_held_out(spark, labels, texts):
    rows = {r.doc_id: r for r in queries.op7_toxicity(spark, SF).collect()}
    assert len(rows) == len(texts)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    held = [i for i in labels if rows[i].held_out]
    truth, score = np.array([labels[i].toxic for i in held]), np.array([rows[i].score for i in held])
    assert auc(score, truth) > 0.9 and (score[truth == 0] < 0.7).mean() > 0.97


def test_tables_equal_counting(spark):
    """The hashed tables give the log-likelihoods of a plain Kneser-Ney count."""
    rows = [(0, "bad worse"), (1, "bad worst"), (2, "good bade"), (3, "good gold")]
    tables = toxicity._tables(spark.createDataFrame(rows, "part int, text string"))
    models = toxicity.Models(tables)
    n, d = toxicity.ORDER, toxicity.DISCOUNT
    words = {True: ["bad", "worse", "bad", "worst"], False: ["good", "bade", "good", "gold"]}
    pad = lambda w: toxicity.START * (n - 1) + w + toxicity.END
    every = {pad(w)[k:k + n] for side in words.values() for w in side for k in range(len(w) + 1)}
    longer = {g[n - m:] for g in every for m in range(2, n + 1)}
    left = {}
    for g in longer:
        left[g[1:]] = left.get(g[1:], 0) + 1

    def shared(h, x):
        p = 1 / 4096
        for m in range(1, n):
            before = h[len(h) - m + 1:] if m > 1 else ""
            beside = [g for g in left if len(g) == m and g[:-1] == before]
            total = sum(left[g] for g in beside)
            if total:
                p = (max(left.get(before + x, 0) - d, 0) + d * len(beside) * p) / total
        return p

    def log_p(word, side):
        grams = [pad(w)[k:k + n] for w in words[side] for k in range(len(w) + 1)]
        out = 0.0
        for k in range(len(word) + 1):
            g = pad(word)[k:k + n]
            beside = [x for x in grams if x[:-1] == g[:-1]]
            p = shared(g[1:-1], g[-1])
            if beside:
                p = (max(grams.count(g) - d, 0) + d * len(set(beside)) * p) / len(beside)
            out += np.log(p)
        return out

    some = ["bad", "good", "gone", "worsted", "x"]
    want = [log_p(w, True) - log_p(w, False) for w in some]
    assert np.allclose(models.evidence(some), want, atol=1e-4)
    assert models.evidence(["bad"])[0] > 1 > -1 > models.evidence(["gold"])[0]


def test_toxicity_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (5, 0, "x"), (6, None, "x"), (77, 1, "x"), (None, 1, "x"), (8, 0, "x"), (9, 1, "x")],
                                   "doc_id long, toxic int, text string")
    rows = toxicity.toxicity(odd_documents, labels).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.held_out, r.score))
    assert len(rows) == 11 and len(by[1]) == 1 and {s for _, s in by[2]} == {s for _, s in by[3]} == {s for _, s in by[4]}
    assert {r.score for r in toxicity.toxicity(odd_documents, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(odd_documents.limit(0), labels).count() == 0
