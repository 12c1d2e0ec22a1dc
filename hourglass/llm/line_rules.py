"""Quality rules with cross-document line frequency.

Lines are normalised and hashed, and the distinct documents that hold a line are counted per host. Lines
held by more than ``max_documents`` of a host are page furniture: they can be removed, and a document that
loses more than ``max_removed`` percent of its words with them is depleted and rejected. Documents of equal
text count once for a line, so that a page that is mirrored does not become furniture by its own copies. With
``near_copies`` a group of near-duplicates (``lsh_forest``) counts once too, wherever that can change a verdict.

Defined results: a null or empty text has no words and fails the base rules; a null host is a host of its
own; rows equal in id, host and text are counted once and share their verdict; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm import lsh_forest
from hourglass.llm.storage import written
from hourglass.llm.text import WordHashes, enter, keeps, map_batches, signed

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MAX_DOCUMENTS = 20
MAX_REMOVED = 66


def repeated_words(hashes: np.ndarray, width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur at least twice."""
    n = len(hashes) - width + 1
    if n < 2:
        return 0
    window = hashes[:n].copy()
    for j in range(1, width):
        window = window * np.uint64(0x9E3779B97F4A7C15) + hashes[j:n + j]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    hit = np.zeros(len(hashes), bool)
    for j in range(width):
        hit[starts + j] = True
    return int(hit.sum())


def line_key(words: list[bytes]) -> int:
    """Hash of a normalised line: words in lower case (A-Z), single spaces."""
    return signed(xxhash.xxh64_intdigest(b" ".join(words).lower()))


_HASHES = WordHashes()
keeps(__name__, _HASHES.clear)


def _profile(cols: list[list]) -> list[list]:
    out: list[list] = [[] for _ in range(6)]
    for text, n_chars in zip(*cols, strict=True):
        text = text or b""
        words: list[bytes] = []
        seen: set[bytes] = set()
        lines: Counter = Counter()
        dup = 0
        for line in text.split(b"\n"):
            found = line.split()
            if found:
                words += found
                dup += line in seen
                seen.add(line)
                lines[line_key(found)] += len(found)
        row = (len(words), (n_chars or 0) - sum(text.count(c) for c in SPACES), sum(text.count(c) for c in SYMBOLS),
               dup, repeated_words(_HASHES.of(words)), [{"line": k, "words": v} for k, v in lines.items()])
        for c, v in zip(out, row, strict=True):
            c.append(v)
    return out


def profile(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document: base counts and its normalised lines (``line`` hash, ``words`` in it)."""
    meta = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    meta = meta.withColumn("row_key", F.xxhash64("doc_id", "host", "text"))

    def rows(cols):
        enter(__name__)
        return [*cols[:2], *cols[2:4], *_profile(cols[4:])]

    schema = ("doc_id {}, host binary, text_key long, row_key long, n_words long, word_chars long, n_symbols long, "
              "n_dup_lines long, n_repeat_words long, lines array<struct<line: long, words: int>>")
    kind = docs.schema[id_col].dataType.simpleString()
    kind = "binary" if kind == "string" else kind
    out = map_batches(meta.select("doc_id", "host", "text_key", "row_key", "text", F.length("text").alias("n_chars")),
                      schema.format(kind), rows)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)).withColumn(
        "host", F.col("host").cast("string"))


def frequent_lines(profiles: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(host, line) of the lines that more than ``max_documents`` documents of different text hold."""
    lines = profiles.select("host", "text_key", F.explode("lines.line").alias("line"))
    return (lines.groupBy("host", "line", "text_key").agg(F.lit(1).alias("one"))
            .groupBy("host", "line").agg(F.count("*").alias("n_documents"))
            .filter(F.col("n_documents") > max_documents))


def _same_line() -> Column:
    return F.col("host").eqNullSafe(F.col("hot_host")) & (F.col("line") == F.col("hot_line"))


def _verdicts(profiles: DataFrame, hot: DataFrame, max_removed: int) -> DataFrame:
    """Words in the ``hot`` lines (hot_host, hot_line) and the verdict per document."""
    held = profiles.select("row_key", "host", F.explode("lines").alias("l")).select(
        "row_key", "host", F.col("l.line").alias("line"), F.col("l.words").alias("words"))
    lost = (held.join(hot, _same_line())
            .groupBy("row_key", "line").agg(F.max("words").alias("words"))
            .groupBy(F.col("row_key").alias("lost_key")).agg(F.sum("words").cast("long").alias("n_removed_words")))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = profiles.drop("lines").join(lost, F.col("row_key") == F.col("lost_key"), "left").withColumn(
        "n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
    depleted = 100 * F.col("n_removed_words") > max_removed * F.col("n_words")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "n_removed_words", base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"),
                      "row_key")


def _recounted(docs: DataFrame, text_col: str, profiles: DataFrame, hot: DataFrame, max_documents: int,
               max_removed: int) -> DataFrame:
    """``hot`` with the lines of depleted documents counted once per group of near copies. Groups are found among
    all texts that hold such a line; other lines decide no verdict and keep their count."""
    poor = written(_verdicts(profiles, hot, max_removed).filter("NOT base_failed AND NOT kept").select("row_key"), "poor")
    if poor.isEmpty():
        return hot
    contested = written(profiles.join(poor, "row_key", "left_semi").select("host", F.explode("lines.line").alias("line"))
                        .join(hot, _same_line()).select("hot_host", "hot_line").distinct(), "contested")
    held = written(profiles.select("host", "text_key", F.explode("lines.line").alias("line")).join(
        contested, _same_line()).select("host", "line", "text_key").distinct(), "holders")
    texts = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).join(
        held.select("text_key").distinct(), "text_key", "left_semi")
    groups = lsh_forest.near_duplicates(texts, "text_key").select(
        F.col("doc_id").alias("text_key"), F.col("component_id").alias("group")).distinct()
    still = (held.join(groups, "text_key").groupBy("host", "line", "group").agg(F.lit(1).alias("one"))
             .groupBy("host", "line").agg(F.count("*").alias("n_documents")).filter(F.col("n_documents") > max_documents))
    other = hot.join(contested.select(F.col("hot_host").alias("host"), F.col("hot_line").alias("line")), _same_line(), "left_anti")
    return written(other.unionByName(still.select(F.col("host").alias("hot_host"), F.col("line").alias("hot_line"))), "recounted")


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               max_documents: int = MAX_DOCUMENTS, max_removed: int = MAX_REMOVED, near_copies: bool = False) -> DataFrame:
    """Base counts, words in frequent lines and the verdict per document (see the module's text).

    The line counts are partial sums before every shuffle, so a line that a third of all documents hold is
    one row per task; the lookup of frequent lines is a plain join that AQE can split.
    """
    profiles = written(profile(docs, id_col, text_col, host_col), "lines")
    hot = frequent_lines(profiles, max_documents).select(
        F.col("host").alias("hot_host"), F.col("line").alias("hot_line"))
    if near_copies:
        hot = _recounted(docs, text_col, profiles, written(hot, "frequent"), max_documents, max_removed)
    return _verdicts(profiles, hot, max_removed)


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``docs`` with the frequent lines of each host taken out of the texts; rows and columns stay.

    The lines are found by their normalised form, as in :func:`line_rules`; each document's frequent lines
    come to it as one array, bounded by the document's own lines.
    """
    profiles = written(profile(docs, id_col, text_col, host_col), "lines")
    hot = frequent_lines(profiles, max_documents).select(
        F.col("host").alias("hot_host"), F.col("line").alias("hot_line"))
    held = profiles.select("row_key", "host", F.explode("lines.line").alias("line"))
    lost = (held.join(hot, F.col("host").eqNullSafe(F.col("hot_host")) & (F.col("line") == F.col("hot_line")))
            .groupBy(F.col("row_key").alias("lost_key")).agg(F.collect_set("line").alias("__lost")))
    keyed = docs.withColumn("__row_key", F.xxhash64(id_col, F.col(host_col).cast("string"), text_col))
    joined = keyed.join(lost, F.col("__row_key") == F.col("lost_key"), "left").drop("lost_key", "__row_key")

    @F.pandas_udf("string")
    def without(texts: pd.Series, lost_lines: pd.Series) -> pd.Series:
        def one(text, gone):
            if text is None or gone is None:
                return text
            gone = set(gone)
            kept = [x for x in text.split("\n") if not (w := x.encode().split()) or line_key(w) not in gone]
            return "\n".join(kept)

        return pd.Series([one(t, g) for t, g in zip(texts, lost_lines, strict=True)], dtype=object)

    return joined.withColumn(text_col, without(F.col(text_col), F.col("__lost"))).drop("__lost")
