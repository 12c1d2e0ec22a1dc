"""Operator 7: counts of many different strings, and the fit's sample."""

import random
from collections import Counter

import numpy as np

from hourglass.llm import toxicity


def test_many_strings_do_not_share_counts(spark):
    pick = random.Random(7)
    word = lambda: "".join(chr(0x4E00 + pick.randrange(20_000)) for _ in range(6))
    toxic, ordinary = [word() for _ in range(300)], [word() for _ in range(60_000)]
    rows = [(i % 2, " ".join(toxic[i::10])) for i in range(10)] + [(2 + i % 2, " ".join(ordinary[i::100])) for i in range(100)]
    models = toxicity.Models(toxicity._tables(spark.createDataFrame(rows, "part int, text string")))
    n, d = toxicity.ORDER, toxicity.DISCOUNT
    grams = {side: Counter(w[k:k + n] for w in (toxicity.START * (n - 1) + x + toxicity.END for x in words)
                           for k in range(len(w) - n + 1)) for side, words in ((1, toxic), (0, ordinary))}
    left = Counter(g[1:] for g in {g[n - m:] for c in grams.values() for g in c for m in range(2, n + 1)})
    total, kinds = {"left": Counter(), 1: Counter(), 0: Counter()}, {"left": Counter(), 1: Counter(), 0: Counter()}
    for name, counts in (("left", left), *grams.items()):
        for g, c in counts.items():
            total[name][g[:-1], len(g)] += c
            kinds[name][g[:-1], len(g)] += 1

    def next_p(name, counts, g, p):
        at = g[:-1], len(g)
        return (max(counts[g] - d, 0) + d * kinds[name][at] * p) / total[name][at] if total[name][at] else p

    def want(w):
        padded, out = toxicity.START * (n - 1) + w + toxicity.END, 0.0
        for k in range(len(padded) - n + 1):
            g, p = padded[k:k + n], 1 / 4096
            for m in range(1, n):
                p = next_p("left", left, g[n - m:], p)
            out += np.log(next_p(1, grams[1], g, p)) - np.log(next_p(0, grams[0], g, p))
        return out

    assert np.allclose(models.evidence(toxic), [want(w) for w in toxic], atol=1e-3)


def test_fit_sample_holds_the_rare_class():
    assert toxicity.fit_shares(50, 10_000, 1_000) == (50, 950) and toxicity.fit_shares(10, 20, 1_000) == (10, 20)
    assert toxicity.fit_shares(5_000, 9_000, 1_000) == (500, 500) and toxicity.fit_shares(9_000, 50, 1_000) == (950, 50)
    pick = np.random.default_rng(1)
    x, y = pick.normal(size=(400, 2)), (pick.random(400) < 0.3).astype(int)
    twice = np.concatenate([np.arange(400), np.flatnonzero(y == 0)])
    assert np.allclose(toxicity.fit_logistic(x[twice], y[twice]), toxicity.fit_logistic(x, y, counts=np.where(y, 1.0, 2.0)), atol=1e-6)
