"""Substring deduplication by a relative Lempel-Ziv parse against hash-partitioned reference blocks.

A document is parsed into phrases whose starts depend only on the words around them: every window of
``width`` words is assigned to its anchor, the smallest hashed run of ``ANCHOR`` words inside it, and windows
in a row with one anchor make a phrase. The corpus's phrases, by anchor, are the reference; an anchor's hash
gives its block. A window that occurs elsewhere has the same anchor there, so a document meets only the
blocks that can hold a factor of it, and no factor of ``width`` words is lost.

* Greedy step: a phrase that the reference holds more than once is a long factor; all its windows repeat.
* Boundary check: a phrase found once whose anchor the reference also holds with other phrases may still share
  a part with them. Only there, at the ends of factors, are single windows looked up.

Words inside repeated windows become duplicate spans; positions are judged on the input, so every copy's
span is reported. Words, phrases and windows are compared by two independent 64-bit hashes. All counting is
by partial sums before a shuffle; the lookups are plain joins, which AQE splits where a passage is in a third
of all documents; no group of occurrences is ever gathered.

Defined results: null, empty and short texts (under ``width`` words) have no spans; rows that are equal in id
and text are separate occurrences, so they repeat each other; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import decided, forget, written
from hourglass.llm.text import WordHashes, enter, keeps, mix, row_key, slices

WIDTH = 35
#: Words of an anchor: long enough that unrelated texts seldom share one.
ANCHOR = 8

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_HASHES = tuple(WordHashes(seed) for seed in (11, 29))
keeps(__name__, lambda: [t.clear() for t in _HASHES])


def run_hashes(h: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every run of ``width`` words, by doubling."""
    n = len(h) - width + 1
    out, done, power, factor, at = None, 0, h, base, 1
    left = width
    while left:
        if left & 1:
            piece = power[done:done + n]
            out = piece.copy() if out is None else out * factor + piece
            done += at
        left >>= 1
        if left:
            power = power[:len(power) - at] * factor + power[at:]
            factor = np.uint64(int(factor) ** 2 & 0xFFFFFFFFFFFFFFFF)
            at <<= 1
    return out


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


class Phrases:
    """The phrases of one document: anchor hash, first window, number of windows, content hashes."""

    def __init__(self, words: list[bytes], width: int, anchor: int):
        n = len(words) - width + 1
        self.count = max(0, n)
        if n <= 0:
            return
        self.hashes = [t.of(words) for t in _HASHES]
        runs = mix(run_hashes(self.hashes[0], anchor, _BASES[0]))
        inside = width - anchor + 1
        # the leftmost smallest run of each window
        places = np.lib.stride_tricks.sliding_window_view(runs, inside).argmin(axis=1) + np.arange(n)
        self.first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        self.anchor = runs[places[self.first]].view(np.int64)
        self.windows = np.diff(np.append(self.first, n))
        # a phrase's content: a sum over its words, scaled back to its first word; with the anchor, whose hash is
        # independent, two phrases are compared by 128 bits
        base = _BASES[1]
        ends = self.first + self.windows + width - 1
        sums = np.append(np.uint64(0), np.cumsum(mix(self.hashes[1]) * _powers(base, len(words)), dtype=np.uint64))
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        content = (sums[ends] - sums[self.first]) * _powers(inverse, int(self.first[-1]) + 1)[self.first]
        self.content = mix(content + self.windows.astype(np.uint64) * base).view(np.int64)

    def window_hashes(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(mix(run_hashes(mix(h), width, base)).view(np.int64) for h, base in zip(self.hashes, _BASES, strict=True))


def _phrase_rows(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    names = ["key", "anchor", "content", "first", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for batch in batches:
            for part in slices(batch):
                out: list[list[np.ndarray]] = [[] for _ in names]
                for key, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    p = Phrases(text.split() if text else [], width, anchor)
                    if p.count:
                        for c, v in zip(out, (np.full(len(p.first), key, np.int64), p.anchor, p.content,
                                              p.first.astype(np.int32), p.windows.astype(np.int32)), strict=True):
                            c.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)

    return docs.select("row_key", "text").mapInArrow(
        run, "key long, anchor long, content long, first int, windows int")


def _window_rows(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    """Windows of the phrases named in ``check`` (their first windows); ``docs``: row_key, text, check."""
    names = ["key", "at", "w1", "w2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for batch in batches:
            for part in slices(batch, 2 << 20):
                out: list[list[np.ndarray]] = [[] for _ in names]
                for key, text, check in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(),
                                            part.column(2).to_pylist(), strict=True):
                    p = Phrases(text.split(), width, anchor)
                    chosen = np.isin(p.first, np.array(check))
                    starts, sizes = p.first[chosen], p.windows[chosen]
                    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                    w1, w2 = p.window_hashes(width)
                    for c, v in zip(out, (np.full(len(at), key, np.int64), at.astype(np.int32), w1[at], w2[at]), strict=True):
                        c.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)

    return docs.select("row_key", "text", "check").mapInArrow(run, "key long, at int, w1 long, w2 long")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
             anchor: int = ANCHOR) -> DataFrame:
    """(key, spans): window starts [first, first + windows) that occur elsewhere too, per row key."""
    picked = docs.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    # phrases whose anchor is found once can share no window; the others are few
    phrases = written(_phrase_rows(picked, width, anchor), "phrases")
    often = phrases.groupBy(F.col("anchor").alias("r")).agg(F.count("*").alias("n")).filter("n > 1").select("r")
    shared = written(phrases.join(often, F.col("anchor") == F.col("r"), "left_semi"), "shared")
    forget(phrases)
    distinct = shared.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.min(F.struct("key", "first")).alias("holder"))
    blocks = distinct.groupBy(F.col("anchor").alias("block_anchor")).agg(F.count("*").alias("kinds"))
    # what the reference says of a phrase: found more than once, or found beside others of its anchor
    reference = distinct.join(blocks.filter("kinds > 1"), F.col("anchor") == F.col("block_anchor"), "left").filter(
        "copies > 1 OR kinds > 1").select(F.col("anchor").alias("r"), F.col("content").alias("r1"),
                                          "copies", F.when(F.col("kinds") > 1, F.col("holder")).alias("holder"))
    found = written(shared.join(reference, (F.col("anchor") == F.col("r")) & (F.col("content") == F.col("r1"))).select(
        "key", "first", "windows", "copies", (F.struct("key", "first") == F.col("holder")).alias("beside")), "factors")
    long_factors = found.filter("copies > 1").select("key", F.col("first").alias("a"), (F.col("first") + F.col("windows")).alias("b"))
    # boundary check, window by window; of a phrase found more than once one copy gives the windows, for others
    check = found.filter("beside").groupBy(F.col("key").alias("check_key")).agg(F.collect_set("first").alias("check"))
    texts = picked.join(check, F.col("row_key") == F.col("check_key")).select("row_key", "text", "check")
    windows = written(_window_rows(texts, width, anchor), "windows")
    again = windows.groupBy(F.col("w1").alias("g1"), F.col("w2").alias("g2")).agg(F.count("*").alias("n")).filter("n > 1")
    at_ends = windows.join(again, (F.col("w1") == F.col("g1")) & (F.col("w2") == F.col("g2"))).select(
        "key", F.col("at").alias("a"), (F.col("at") + 1).alias("b"))
    return long_factors.unionByName(at_ends).groupBy(F.col("key").alias("span_key")).agg(
        F.collect_set(F.struct("a", "b")).alias("found_spans"))


def covered(n_words: int, spans, width: int) -> np.ndarray:
    """Mask of the words inside windows that start in the spans."""
    edges = np.zeros(n_words + 1, np.int64)
    for a, b in spans:
        edges[a] += 1
        edges[min(n_words, b + width - 1)] -= 1
    return np.cumsum(edges[:-1]) > 0


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    anchor: int = ANCHOR) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by one space)
    and ``clean``: the kept words in lines as they were, null where nothing is removed (the text stands)."""
    spans = decided(docs.sparkSession, "spans", lambda: repeated(docs, id_col, text_col, width, anchor))
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row_key"))
    joined = keyed.join(spans, F.col("row_key") == F.col("span_key"), "left").select(
        "doc_id", "row_key", "text", F.transform("found_spans", lambda s: F.array(s.a, s.b)).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for batch in batches:
            for part in slices(batch):
                n, gone, digest, clean = [], [], [], []
                for text, found in zip(part.column(2).cast(pa.binary()).to_pylist(), part.column(3).to_pylist(), strict=True):
                    words = text.split() if text else []
                    mask = covered(len(words), found or (), width)
                    kept = [w for w, m in zip(words, mask.tolist(), strict=True) if not m] if found else words
                    n.append(len(words))
                    gone.append(len(words) - len(kept))
                    digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                    clean.append(without(text, mask) if found else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(digest, pa.string()), pa.array(clean, pa.string())],
                    names=["doc_id", "row_key", "n_words", "n_removed", "kept_sha256", "clean"])

    return joined.mapInArrow(
        run, f"doc_id {kind}, row_key long, n_words long, n_removed long, kept_sha256 string, clean string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the repeated passages taken out of the texts; rows and columns stay."""
    spans = decided(docs.sparkSession, "spans", lambda: repeated(docs, id_col, text_col, width, anchor))
    keyed = docs.withColumn("__row_key", row_key(id_col, text_col))
    joined = keyed.join(spans, F.col("__row_key") == spans["span_key"], "left").withColumn(
        "__spans", F.transform(spans["found_spans"], lambda s: F.array(s.a, s.b))).drop(spans["found_spans"], spans["span_key"]).drop("__row_key")

    @F.pandas_udf("string")
    def edited(texts: pd.Series, found: pd.Series) -> pd.Series:
        def one(text: str, spans) -> str:
            raw = text.encode()
            return without(raw, covered(len(raw.split()), spans, width))

        return pd.Series([t if s is None else one(t, s) for t, s in zip(texts, found, strict=True)], dtype=object)

    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(edited(F.col(text_col), F.col("__spans")))
    return joined.withColumn(text_col, text).drop("__spans")


def without(text: bytes, mask: np.ndarray) -> str:
    """``text`` without the masked words; kept words stay in their lines."""
    lines, at = [], 0
    for line in text.split(b"\n"):
        words = line.split()
        gone = mask[at:at + len(words)]
        at += len(words)
        if not gone.any():
            lines.append(line)
        elif not gone.all():
            lines.append(b" ".join([w for w, m in zip(words, gone.tolist(), strict=True) if not m]))
    return b"\n".join(lines).decode()
