"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation
estimates each labeller's accuracies (the chance of each vote given the true class) from how the votes agree,
without any hand label, and gives every pattern of votes a posterior probability of being good. The
posteriors then train a linear scorer over hashed text features, which also judges documents on which the
labellers say little.

The votes of all documents are counted by pattern, of which there are at most 3 ** 8; these counts are all
that the estimation needs. The linear scorer is fitted on at most ``FIT_ROWS`` rows, picked by a hash of
their text (a documented bound of the fit only). Labels of the ``labels`` table are never read.

Defined results: null, empty and blank texts have no features, get the votes that no words earn and are
scored by the intercept; repeated rows are scored each and alike; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import written
from hourglass.llm.text import slices

FIT_ROWS = 20_000
DIMENSIONS = 1 << 16
KEEP = 0.5
LABELLERS = ("symbols", "plain_words", "marks", "capitals", "lower_case", "following", "runs", "variety")
GOOD, BAD, NONE = 1, 0, 2

_SYMBOLS = b"#*$%&|<>"
#: A word of letters and digits with at most one mark around or inside, as prose has.
_PLAIN = re.compile(rb"""["'(]?[0-9A-Za-z\x80-\xff]+(?:['.,:/@-][0-9A-Za-z\x80-\xff]+)*[.,;:!?)"']?""")
_MARKS = re.compile(rb"[^0-9A-Za-z\x80-\xff\s]")


def votes(text: bytes | None) -> list[int]:
    """One vote of every labeller; texts of under five words earn none."""
    words = text.split() if text else []
    n = len(words)
    if n < 5:
        return [NONE] * len(LABELLERS)

    def vote(value: float, good: float, bad: float) -> int:
        """Small values are good: up to ``good``, bad from ``bad`` on."""
        return GOOD if value <= good else BAD if value >= bad else NONE

    symbols = sum(text.count(c) for c in _SYMBOLS) / n
    odd = sum(_PLAIN.fullmatch(w) is None for w in words) / n
    marks = len(_MARKS.findall(text)) / len(text)
    capitals = sum(w.isupper() for w in words) / n
    lower = 1 - sum(w.islower() for w in words) / n
    run = longest = following = 0
    for a, b in zip(words, words[1:], strict=False):
        run = run + 1 if a == b else 0
        following += a == b
        longest = max(longest, run)
    kinds = len(set(words)) / n
    return [vote(symbols, 0.05, 0.25), vote(odd, 0.1, 0.4), vote(marks, 0.06, 0.12), vote(capitals, 0.2, 0.6),
            vote(lower, 0.35, 0.7), vote(following / n, 0.05, 0.3), vote(longest, 2, 5),
            NONE if n < 15 else vote(1 - kinds, 0.75, 0.85)]


class VoteModel:
    """Two classes; each labeller's votes independent given the class. No vote says nothing."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200):
        # a document that any labeller calls bad starts as suspect
        good = np.where((patterns == BAD).any(1), 0.2, 0.95)
        cast = (patterns[:, :, None] == np.arange(2)).astype(float)
        for _ in range(rounds):
            before = good
            self.prior = (counts * good).sum() / max(counts.sum(), 1)
            self.prior = min(max(self.prior, 1e-3), 1 - 1e-3)
            seen = np.stack([np.einsum("p,plv->lv", counts * side, cast) + 1 for side in (1 - good, good)])
            self.chance = seen / seen.sum(2, keepdims=True)  # class (bad, good), labeller, vote
            self.cast = seen.sum(2)
            good = self.posterior(patterns)
            if np.abs(good - before).max(initial=0) < 1e-6:
                break

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        at = np.arange(patterns.shape[1])
        logs = []
        for c, p in ((0, 1 - self.prior), (1, self.prior)):
            chance = np.append(np.log(self.chance[c]), np.zeros((len(at), 1)), axis=1)  # the last column: no vote
            logs.append(np.log(p) + chance[at, patterns].sum(1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))

    def accuracies(self) -> dict[str, float]:
        """Share of a labeller's votes that agree with the class."""
        right = self.chance[1][:, GOOD] * self.cast[1] + self.chance[0][:, BAD] * self.cast[0]
        return dict(zip(LABELLERS, (right / self.cast.sum(0)).round(4).tolist(), strict=True))


_WORD_SHAPE = re.compile(rb"[a-z\x80-\xff]+")
_CAPITAL_SHAPE = re.compile(rb"[A-Z]+")
_DIGITS = re.compile(rb"[0-9]+")


class Hashed(dict):
    """Feature numbers of tokens, in a bounded table."""

    def __missing__(self, token: bytes) -> tuple[int, int]:
        shape = _DIGITS.sub(b"0", _CAPITAL_SHAPE.sub(b"A", _WORD_SHAPE.sub(b"a", token)))
        found = (xxhash.xxh32_intdigest(token.lower(), 1) % DIMENSIONS, xxhash.xxh32_intdigest(shape, 2) % DIMENSIONS)
        if len(self) < 1 << 18:
            self[token] = found
        return found


_HASHED = Hashed()


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and weights of unit length: tokens, their shapes, and words that follow themselves."""
    words = text.split() if text else []
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    pairs = np.array([_HASHED[w] for w in words], np.int64)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    kinds, n = np.unique(pairs[:, 0], return_counts=True)
    shapes, m = np.unique(pairs[:, 1], return_counts=True)
    mean = len(words)
    # shapes and repeats as shares, so that long texts weigh like short ones
    index = np.concatenate([kinds, shapes, [7, 11, 13]])
    value = np.concatenate([0.3 * np.sqrt(n / (n ** 2).sum() ** 0.5 / len(kinds) ** 0.5), m / mean,
                            [again / mean, len(set(words)) / mean, min(mean, 200) / 200]])
    return index, value


class Scorer:
    """Linear scorer over hashed features, fitted to posteriors by AdaGrad."""

    def __init__(self):
        self.weights, self.bias = np.zeros(DIMENSIONS), 0.0

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.3):
        past, past_bias = np.full(DIMENSIONS, 1e-6), 1e-6
        order = np.random.default_rng(0)
        for _ in range(epochs if rows else 0):
            mixed = order.permutation(len(rows))
            for at in range(0, len(rows), batch):
                some = mixed[at:at + batch]
                sizes = [len(rows[i][0]) for i in some]
                index, value = (np.concatenate([rows[i][j] for i in some]) for j in (0, 1))
                row = np.repeat(np.arange(len(some)), sizes)
                z = np.bincount(row, self.weights[index] * value, len(some)) + self.bias
                off = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[some]
                held, place = np.unique(index, return_inverse=True)
                g = np.bincount(place, off[row] * value, len(held)) / len(some)
                past[held] += g * g
                self.weights[held] -= rate * g / np.sqrt(past[held])
                past_bias += off.mean() ** 2
                self.bias -= rate * off.mean() / past_bias ** 0.5
        return self

    def score(self, text: bytes | None) -> float:
        index, value = features(text)
        z = float((self.weights[index] * value).sum()) + self.bias
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def vote_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``pattern`` (votes as base-3 digits) and the text's hash per row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                codes = [sum(v * 3 ** i for i, v in enumerate(votes(t))) for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(codes, pa.int32())],
                                                 names=["doc_id", "text_key", "pattern"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key")).mapInArrow(
        run, f"doc_id {kind}, text_key long, pattern int")


def digits(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(len(LABELLERS))) % 3


def estimate(rows: DataFrame) -> VoteModel:
    """The vote model of all documents, from the counts of their patterns."""
    counted = rows.groupBy("pattern").agg(F.count("*").alias("n")).collect()
    codes = np.array(sorted((r.pattern, r.n) for r in counted), np.int64).reshape(-1, 2)
    return VoteModel(digits(codes[:, 0]), codes[:, 1].astype(float))


def weak_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: ``doc_id``, ``n_votes`` cast, ``posterior`` (good, by the votes) and ``score`` (good, by the scorer)."""
    spark = docs.sparkSession
    rows = written(vote_rows(docs, id_col, text_col), "votes")
    model = estimate(rows)
    # the rows with the smallest text hashes, by a bound on the hash that lets a little more than fit_rows through
    n = rows.count()
    share = min(1.0, 1.1 * fit_rows / max(n, 1))
    most = int(-(2 ** 63) + share * (2 ** 64 - 1)) if share < 1 else 2 ** 63 - 1
    sample = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key")).filter(
        F.col("text_key") <= most).orderBy("text_key").limit(fit_rows).toArrow()
    texts = sample["text"].cast(pa.binary()).to_pylist()
    target = model.posterior(np.array([votes(t) for t in texts], np.int64).reshape(-1, len(LABELLERS))) if texts else np.empty(0)
    scorer = spark.sparkContext.broadcast(Scorer().fit([features(t) for t in texts], target))
    given = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                cast = np.array([votes(t) for t in texts], np.int64).reshape(-1, len(LABELLERS))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array((cast != NONE).sum(1)), pa.array(given.value.posterior(cast)),
                     pa.array([scorer.value.score(t) for t in texts], pa.float64())], names=["doc_id", "n_votes", "posterior", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_votes long, posterior double, score double")
