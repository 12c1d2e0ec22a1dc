"""Token counts by a map-side lookup in two tiers.

A first pass lets every task summarise its pre-tokens and send its most frequent ones, with their counts and
token lengths; the sums give a table of at most ``table_entries`` pre-tokens (a proven bound), which is
broadcast. The second pass counts: pre-tokens in the broadcast table cost one lookup, all others are encoded
by the library and kept in a bounded cache of the worker. No pre-token of the corpus is shuffled, and the
table only saves time: counts are the library's for every text.

Defined results: a null text counts as empty (0 tokens, 0 bytes); repeated rows are counted each; texts that
hold one of the vocabulary's added tokens are encoded whole, as the library treats them before it splits
pre-tokens; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.text import enter, keeps, slices

VOCABULARY = "byte_bpe_50k.json"
TABLE_ENTRIES = 1 << 16
TASK_ENTRIES = 1 << 12
CACHE_ENTRIES = 1 << 18

_SPLIT = regex.compile(public_tokenizers.PATTERN)

_TOKENIZERS: dict[str, object] = {}


def tokenizer(path: str):
    """The library's tokenizer for a vocabulary file, once per worker; no truncation, no padding."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


class Lengths(dict):
    """Tier one: the broadcast table. Tier two: what the worker has encoded itself, at most CACHE_ENTRIES."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.tokenizer = tokenizer(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, int] = {}

    def __missing__(self, token: str) -> int:
        n = self.cache.get(token)
        if n is None:
            n = self.whole(token)
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[token] = n
        return n

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        if any(t in text for t in self.added):
            return self.whole(text)
        return sum(map(self.__getitem__, _SPLIT.findall(text)))


_LENGTHS: dict = {}
keeps(__name__, _LENGTHS.clear)


def _lengths(path: str, frequent) -> Lengths:
    """Kept per worker; ``frequent`` is a broadcast or None."""
    key = (path, id(frequent))
    if key not in _LENGTHS:
        _LENGTHS.clear()
        _LENGTHS[key] = Lengths(path, {} if frequent is None else frequent.value), frequent
    return _LENGTHS[key][0]


def frequent_pretokens(docs: DataFrame, text_col: str, path: str, table_entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Token lengths of the corpus's most frequent pre-tokens, from a summary of every task."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    counts.update(_SPLIT.findall(text or ""))
                if len(counts) > 64 * TASK_ENTRIES:
                    counts = Counter(dict(counts.most_common(16 * TASK_ENTRIES)))
        top = [(t, n) for t, n in counts.most_common(TASK_ENTRIES) if n > 1]
        lengths = _lengths(path, None)
        yield pa.RecordBatch.from_pydict({
            "token": pa.array([t for t, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64()),
            "length": pa.array([lengths.whole(t) for t, _ in top], pa.int32())})

    sums = (docs.select(text_col).mapInArrow(summarise, "token string, n long, length int")
            .groupBy("token").agg(F.sum("n").alias("n"), F.first("length").alias("length")))
    return {r.token: r.length for r in sums.orderBy(F.desc("n"), "token").limit(table_entries).collect()}


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 table_entries: int = TABLE_ENTRIES) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` per row (see the module's text)."""
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_pretokens(docs, text_col, path, table_entries))
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = docs.schema[id_col].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        lengths = _lengths(path, table)
        for batch in batches:
            for part in slices(batch):
                n = [lengths.count(t) if t else 0 for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    return picked.mapInArrow(count, f"doc_id {kind.simpleString()}, n_bytes long, n_tokens long")
