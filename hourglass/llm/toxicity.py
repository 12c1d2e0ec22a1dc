"""Toxicity by class-conditional Kneser-Ney models.

Expressions are words. Two models of their characters, one of toxic and one of ordinary labelled texts, give
each word a log-likelihood; both back off to one shared model, whose continuation counts (how many different
characters come before a string) pool all labelled words, so rare expressions are smoothed alike and only
what the classes differ in speaks. A document's evidence is the difference of the two log-likelihoods of its
strongest words, plain and normalised by length, and of all its words on average; a logistic fit maps the
evidence to a score.

Word counts (documents of a class with the word) and the strings derived from them cover all labelled rows
outside the held-out third, are aggregated by Spark, and end in tables of one row per string, found by the string's
64-bit hash, so no string shares another's counts. They grow with the different strings of the labelled rows and
are broadcast. For the logistic fit each half of the labelled rows is scored by models of the other half, on at
most ``FIT_ROWS`` rows, drawn per class and weighted to the classes' sizes (a documented bound of the fit only).

Defined results: null, empty and blank texts get the score of no evidence; labels that are null, or of unknown
ids, are ignored; an id with several labels counts as toxic if one says so; without labelled rows of both
classes every score is 0; rows without an id are in the third that their null's text ("") belongs to; repeated
rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import written
from hourglass.llm.text import enter, keeps, mix, slices

#: Characters of the classes' strings; the shared model has strings of one less.
ORDER = 5
DISCOUNT = 0.75
FIT_ROWS = 20_000
THRESHOLD = 0.7
#: Words whose evidence a worker keeps; two generations.
WORD_ENTRIES = 200_000
START, END = "\x02", "\x03"
#: Counts by class and half of the labelled rows.
PARTS = ("toxic_a", "toxic_b", "ordinary_a", "ordinary_b")

_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def remainder(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _key(h: np.ndarray, order: int) -> np.ndarray:
    return mix(h + np.uint64(order * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _strings(strings: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of strings of ``size`` characters, and of what comes before their last character."""
    codes = _codes("".join(strings)).reshape(len(strings), size) + np.uint64(1)
    h = np.zeros(len(strings), np.uint64)
    before = h
    for j in range(size):
        before = h
        h = h * _BASE + codes[:, j]
    return _key(h, size), _key(before, size - 1)


def _top_strings(rows: DataFrame) -> DataFrame:
    """Strings of ``ORDER`` characters of the padded words, with documents by part; ``rows``: part, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        counts = [Counter() for _ in PARTS]

        def flush() -> pa.RecordBatch:
            out: dict[str, list[int]] = {}
            for p, words in enumerate(counts):
                for word, n in words.items():
                    padded = START * (ORDER - 1) + word + END
                    for k in range(len(padded) - ORDER + 1):
                        out.setdefault(padded[k:k + ORDER], [0] * len(PARTS))[p] += n
                words.clear()
            columns = [pa.array([v[p] for v in out.values()], pa.int64()) for p in range(len(PARTS))]
            return pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *columns], names=["string", *PARTS])

        for batch in batches:
            for part in slices(batch):
                for p, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts[p].update(set(words_of(text)))
                if sum(map(len, counts)) > 4 * WORD_ENTRIES:
                    yield flush()
        yield flush()

    schema = "string string, " + ", ".join(f"{p} long" for p in PARTS)
    return rows.select("part", "text").mapInArrow(run, schema).groupBy("string").agg(*[F.sum(p).alias(p) for p in PARTS])


def _key_sums(strings: DataFrame, shared: bool) -> DataFrame:
    """(kind, key, n) of the tables' entries, pre-summed in every task. ``strings``: string, size and either
    ``left`` (different characters before it) or the parts' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for batch in batches:
            if not batch.num_rows:
                continue
            found: list[tuple[str, np.ndarray, np.ndarray]] = []
            names, sizes = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                own, before = _strings([names[i] for i in at], size)
                if shared:
                    left = batch.column(2).to_numpy()[at]
                    found += [("left", own, left), ("sum", before, left), ("kinds", before, np.ones(len(at), np.int64))]
                    continue
                n = {p: batch.column(2 + i).to_numpy()[at] for i, p in enumerate(PARTS)}
                n |= {"toxic": n["toxic_a"] + n["toxic_b"], "ordinary": n["ordinary_a"] + n["ordinary_b"]}
                for p, v in n.items():
                    found += [(f"{p} n", own, v), (f"{p} sum", before, v), (f"{p} kinds", before, (v > 0).astype(np.int64))]
            for kind, key, n in found:
                keys, at = np.unique(key, return_inverse=True)
                sums = np.bincount(at, n, len(keys)).astype(np.int64)
                held = sums > 0
                yield pa.RecordBatch.from_arrays([pa.array([kind] * int(held.sum()), pa.string()), pa.array(keys[held].view(np.int64)),
                                                  pa.array(sums[held])], names=["kind", "key", "n"])

    columns = ["string", "size", *(["left"] if shared else PARTS)]
    return strings.select(*columns).mapInArrow(run, "kind string, key long, n long")


class Models:
    """The counts of strings: a shared model and one per class, of all labelled rows and of each half.
    ``tables``: for the shared strings and the classes' ones their sorted keys, and counts by kind."""

    def __init__(self, tables: dict[str, tuple[np.ndarray, dict[str, np.ndarray]]]):
        self.tables = tables
        self.starts = {}  # by the keys' first bits, the first row of such a key
        for group, (keys, _) in tables.items():
            bits = len(keys).bit_length() + 2
            first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            self.starts[group] = np.uint64(64 - bits), first, np.append(keys, np.uint64(2 ** 64 - 1))

    def _rows(self, group: str, keys: np.ndarray) -> np.ndarray:
        """Rows of the strings; the last row, of zeros, for those without counts."""
        shift, first, known = self.starts[group]
        at = first[keys >> shift]
        later = np.flatnonzero(known[at] < keys)
        while len(later):
            at[later] += 1
            later = later[known[at[later]] < keys[later]]
        return np.where(known[at] == keys, at, len(known) - 1)

    def _counts(self, group: str, kind: str, rows: np.ndarray) -> np.ndarray:
        column = self.tables[group][1].get(kind)
        return np.zeros(len(rows), np.float32) if column is None else column[rows]

    def evidence(self, words: list[str], half: str = "") -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary); ``half``: "_a" or "_b" for models of that half."""
        pad = START * (ORDER - 1)
        codes = _codes("".join(pad + w + END for w in words)) + np.uint64(1)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
        ends = np.cumsum(sizes)
        scored = np.ones(len(codes), bool)
        for j in range(ORDER - 1):
            scored[ends - sizes + j] = False
        at = np.flatnonzero(scored)
        p = np.full(len(at), 1 / 4096)
        h = [np.zeros(len(codes) + 1, np.uint64)]  # h[m][k + 1]: the m characters that end at k
        for m in range(1, ORDER + 1):
            now = np.zeros(len(codes) + 1, np.uint64)
            now[1:] = h[m - 1][:-1] * _BASE + codes
            h.append(now)
        for m in range(1, ORDER):
            own, before = self._rows("shared", _key(h[m][at + 1], m)), self._rows("shared", _key(h[m - 1][at], m - 1))
            total = self._counts("shared", "sum", before)
            more = (np.maximum(self._counts("shared", "left", own) - DISCOUNT, 0)
                    + DISCOUNT * self._counts("shared", "kinds", before) * p) / np.maximum(total, 1)
            p = np.where(total > 0, np.minimum(more, 1), p)
        own, before = self._rows("class", _key(h[ORDER][at + 1], ORDER)), self._rows("class", _key(h[ORDER - 1][at], ORDER - 1))
        logs = []
        for side in ("toxic", "ordinary"):
            total = self._counts("class", f"{side}{half} sum", before)
            more = (np.maximum(self._counts("class", f"{side}{half} n", own) - DISCOUNT, 0)
                    + DISCOUNT * self._counts("class", f"{side}{half} kinds", before) * p) / np.maximum(total, 1)
            logs.append(np.log(np.where(total > 0, np.minimum(more, 1), p)))
        starts = np.cumsum(sizes - (ORDER - 1)) - (sizes - (ORDER - 1))
        return np.add.reduceat(logs[0] - logs[1], starts) if len(words) else np.empty(0)


#: Strongest words (plain and by length), how many stand out, the mean, and the number of different words.
N_FEATURES = 9
#: Evidence beyond which a word stands out.
STANDS_OUT = 2.0


class Evidence:
    """Features of texts, with the evidence of words met lately."""

    def __init__(self, models: Models, half: str = ""):
        self.models, self.half = models, half
        self.known: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def features(self, texts: list[str | None]) -> np.ndarray:
        if len(self.known) > WORD_ENTRIES:
            self.old, self.known = self.known, {}
        sets = [set(words_of(t)) for t in texts]
        wanted = set().union(*sets) - self.known.keys() if sets else set()
        self.known.update((w, self.old[w]) for w in wanted & self.old.keys())
        new = list(wanted - self.known.keys())
        for at in range(0, len(new), 20_000):
            some = new[at:at + 20_000]
            self.known.update(zip(some, self.models.evidence(some, self.half).tolist(), strict=True))
        return np.array([self._row(s) for s in sets]).reshape(len(sets), N_FEATURES)

    def _row(self, words: set[str]) -> list[float]:
        known = self.known
        if not words:
            return [0.0] * N_FEATURES
        plain = sorted([known[w] for w in words], reverse=True)
        even = sorted([known[w] / (len(w) + 1) for w in words], reverse=True)
        mean, many = sum(plain) / len(plain), sum(v > STANDS_OUT for v in plain)
        plain, even = [max(v, 0.0) for v in plain[:5]] + [0.0] * 5, [max(v, 0.0) for v in even[:2]] + [0.0] * 2
        return [plain[0], plain[1], plain[2], plain[4], even[0], even[1], mean, math.log1p(many), math.log(len(words))]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, counts: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic fit by Newton steps on standardised features; ``counts``:
    how many rows each row stands for."""
    counts = np.ones(len(x)) if counts is None else counts
    mean = np.average(x, 0, counts)
    scale = np.sqrt(np.average((x - mean) ** 2, 0, counts)) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = ridge * counts.sum() * np.append(np.ones(x.shape[1]), 1e-6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (counts * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (counts * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


_EVIDENCE: dict = {}
keeps(__name__, _EVIDENCE.clear)


def _evidence(models, half: str = "") -> Evidence:
    """Kept per worker; ``models`` is a broadcast of the tables."""
    if (id(models), half) not in _EVIDENCE:
        for key in [k for k in _EVIDENCE if k[0] != id(models)]:
            del _EVIDENCE[key]
        _EVIDENCE[id(models), half] = Evidence(Models(models.value), half), models
    return _EVIDENCE[id(models), half][0]


def _tables(rows: DataFrame) -> dict[str, tuple[np.ndarray, dict[str, np.ndarray]]]:
    """All tables of the labelled ``rows`` (part, text)."""
    top = written(_top_strings(rows), "strings")
    ends = F.transform(F.sequence(F.lit(2), F.lit(ORDER)), lambda m: F.substring("string", ORDER + 1 - m, m))
    longer = top.select(F.explode(ends).alias("longer")).distinct()
    left = longer.groupBy(F.expr("substring(longer, 2)").alias("string")).agg(F.count("*").alias("left")).withColumn(
        "size", F.length("string"))
    out: dict[str, tuple[np.ndarray, dict[str, np.ndarray]]] = {}
    for group, sums in (("shared", _key_sums(left, True)), ("class", _key_sums(top.withColumn("size", F.lit(ORDER)), False))):
        found = written(sums.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
        # a row per different string and kind
        kinds = {r.kind: found.filter(F.col("kind") == r.kind).select("key", "n").toArrow()
                 for r in found.select("kind").distinct().collect()}
        held = {k: t["key"].to_numpy().view(np.uint64) for k, t in kinds.items()}
        keys = np.unique(np.concatenate([*held.values(), np.empty(0, np.uint64)]))
        columns = {k: np.zeros(len(keys) + 1, np.float32) for k in kinds}
        for k, t in kinds.items():
            columns[k][np.searchsorted(keys, held[k])] = t["n"].to_numpy()
        out[group] = keys, columns
    return out


def fit_shares(toxic: int, ordinary: int, most: int) -> tuple[int, int]:
    """Rows of each class among ``most``: half of them, or all that there are."""
    t = min(toxic, max(most // 2, most - ordinary))
    return t, min(ordinary, most - t)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             held_out: int = 1, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: ``doc_id``, ``held_out`` and ``score``."""
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        (F.max(label_col) > 0).alias("is_toxic")).filter(remainder("label_id") != held_out)
    # one join at every size; the labels are a written table, so a row listed many times is a skewed join of plain exchanges
    rows = picked.filter(remainder("doc_id") != held_out).join(
        written(known, "known").hint("merge"), F.col("doc_id") == F.col("label_id"))
    half = (remainder("doc_id") != (held_out + 1) % 3).cast("int")
    rows = written(rows.select((half + F.when(F.col("is_toxic"), 0).otherwise(2)).alias("part"), "text",
                               F.xxhash64("doc_id").alias("order")), "labelled")
    tables = spark.sparkContext.broadcast(_tables(rows))

    def fit_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for batch in batches:
            for part in slices(batch):
                parts, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                x = np.zeros((len(texts), N_FEATURES))
                for h, name in ((0, "_b"), (1, "_a")):  # each half by models of the other
                    at = [i for i, p in enumerate(parts) if p % 2 == h]
                    if at:
                        x[at] = _evidence(tables, name).features([texts[i] for i in at])
                yield pa.RecordBatch.from_arrays([pa.array([int(p < 2) for p in parts], pa.int32()), pa.array(list(x), pa.list_(pa.float64()))],
                                                 names=["y", "x"])

    # the smallest hashes of each class; a bound on them lets a few more than wanted through to the sort
    sizes = {r.is_toxic: r["count"] for r in rows.groupBy((F.col("part") < 2).alias("is_toxic")).count().collect()}
    shares = dict(zip((True, False), fit_shares(sizes.get(True, 0), sizes.get(False, 0), fit_rows), strict=True))
    picks = []
    for side, take in shares.items():
        share = min(1.0, 1.1 * take / max(sizes.get(side, 0), 1))
        most = 2 ** 63 - 1 if take == sizes.get(side, 0) or share == 1 else int(-(2 ** 63) + share * 2 ** 64)
        picks.append(rows.filter(((F.col("part") < 2) == side) & (F.col("order") <= most)).orderBy("order", "part").limit(take))
    sample = picks[0].unionByName(picks[1])
    fitted = sample.select("part", "text").mapInArrow(fit_features, "y int, x array<double>").toArrow()
    y = fitted["y"].to_numpy()
    weights = None
    if 0 < y.sum() < len(y):
        counts = np.where(y == 1, sizes[True] / y.sum(), sizes[False] / (len(y) - y.sum()))
        weights = fit_logistic(np.array(fitted["x"].to_pylist()), y, counts=counts)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for batch in batches:
            for part in slices(batch):
                scores = np.zeros(part.num_rows)
                if weights is not None:
                    x = _evidence(tables).features(part.column(1).to_pylist())
                    scores = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(scores)],
                                                 names=["doc_id", "held_out", "score"])

    return picked.withColumn("held_out", remainder("doc_id") == held_out).mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double")
