"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items form one automaton over words. Training texts stream through it: at every word
the longest suffix of what was read that occurs in an item is known. Where that length reaches ``width``,
the last ``width`` words are a window of some item and are hit; an item of fewer words is hit where all of
it ends. Hit spans are removed, and so is the whole text where they cover more than a limit.

Tasks normalise the items and pack them into blocks of at most ``block_words`` words, so an automaton has a
proven size bound whatever the size of the benchmark. Blocks are files in the shared folder, which the scanning
tasks read; only their keys reach the driver. The hits of the blocks are united per document. A benchmark below
the bound is one block and one pass, without any shuffle of documents.

Defined results: null or empty texts have no words and are not contaminated; items without words match
nothing; items of equal text are all reported; items without an id hit words but are not named; rows that
repeat an item id count as one item; repeated documents get equal rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import dataset, fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import shared_folder, written
from hourglass.llm.text import enter, keeps, row_key, slices

WIDTH = 10
BLOCK_WORDS = 50_000

#: Words of a lower-cased (A-Z) text: runs of a-z, 0-9 and bytes of non-ASCII characters.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normalised(text: bytes | None) -> list[bytes]:
    return _WORD.findall(text.lower()) if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over words, with the items that a match of enough words belongs to."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int = WIDTH):
        self.width = width
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        self.names = [name for name, _ in items]
        for i, (_, words) in enumerate(items):
            last = 0
            for at, w in enumerate(words, 1):
                last = self._add(last, w)
                while len(ends) < len(self.next):
                    ends.append(set())
                if at >= width:
                    ends[last].add(i)
        self._finish(ends, items)

    def _state(self, length: int, nexts: dict[bytes, int], link: int) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _finish(self, ends: list[set[int]], items) -> None:
        """``wide``: items with a window of ``width`` words that ends in a state (kept where the state's
        longest string has that many). ``short``: (length, item) of the short items that end there."""
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        for v in order:
            if self.length[self.link[v]] >= self.width:
                ends[self.link[v]] |= ends[v]
        own: dict[int, list[tuple[int, int]]] = {}
        for i, (_, words) in enumerate(items):
            if 0 < len(words) < self.width:
                v = 0
                for w in words:
                    v = self.next[v][w]
                own.setdefault(v, []).append((len(words), i))
        self.wide: list[tuple[int, ...]] = [()] * len(self.next)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for v in reversed(order):
            up = self.link[v]
            if self.length[up] >= self.width:
                self.wide[v] = self.wide[up]
            elif self.length[v] >= self.width:
                self.wide[v] = tuple(sorted(ends[v]))
            self.short[v] = self.short[up] + tuple(own.get(v, ()))

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans [start, end) in order, merged, and the items with occurring windows."""
        nexts, link, length, width = self.next, self.link, self.length, self.width
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        state = n = 0
        for at, w in enumerate(words, 1):
            to = nexts[state].get(w)
            if to is None:
                while to is None and state:
                    state = link[state]
                    to = nexts[state].get(w)
                if to is None:
                    n = 0
                    continue
                n = length[state]
            state = to
            n += 1
            hit = 0
            if n >= width:
                hit = width
                found.update(self.wide[state])
            if self.short[state]:
                for size, i in self.short[state]:
                    if size <= n:
                        hit = max(hit, size)
                        found.add(i)
            if hit:
                start = at - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at))
        return spans, found


def item_pieces(benchmark: DataFrame, item_col: str, text_col: str, block_words: int = BLOCK_WORDS, width: int = WIDTH) -> DataFrame:
    """``name``, ``words``, ``n`` of every different item with words; an item of more than a block is cut into pieces
    that overlap by ``width - 1`` words and so hold all its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                names, pieces = [], []
                for name, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    words = normalised(text)
                    for at in range(0, max(1, len(words) - width + 1) if words else 0, block_words):
                        names.append(name)
                        pieces.append(words[at:at + block_words + width - 1])
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(pieces, pa.list_(pa.binary())),
                                                  pa.array(map(len, pieces), pa.int64())], names=["name", "words", "n"])

    items = benchmark.select(F.col(item_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("text"))
    return items.mapInArrow(run, "name string, words array<binary>, n long").distinct()


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int = BLOCK_WORDS,
                width: int = WIDTH) -> list[str]:
    """Folders of the written blocks: pieces of at most ``block_words`` words together (one piece at least). Pieces are
    dealt to groups by their hash and each group is cut into blocks, so their number follows the words alone, not the
    partitions."""
    spark = benchmark.sparkSession
    pieces = written(item_pieces(benchmark, item_col, text_col, block_words, width), "items")
    parts = -(-(pieces.agg(F.sum("n")).first()[0] or 0) // block_words)
    if not parts:
        return []

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str | None] = []
        own: list[list[bytes]] = []
        n, at = 0, None

        def block() -> pa.RecordBatch:
            # named by its content, so a task that runs again writes the same blocks
            key = xxhash.xxh128_hexdigest(repr((names, own)).encode())
            return pa.RecordBatch.from_arrays([pa.array([key] * len(names)), pa.array(names, pa.string()),
                                               pa.array(own, pa.list_(pa.binary()))], names=["block", "name", "words"])

        for batch in batches:
            for group, name, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own and (group != at or n + len(words) > block_words):
                    yield block()
                    names, own, n = [], [], 0
                at = group
                names.append(name)
                own.append(words)
                n += len(words)
        if own:
            yield block()

    schema = "block string, name string, words array<binary>"
    folder = shared_folder(spark, "blocks")
    group = F.pmod(F.xxhash64("name", "words"), F.lit(parts)).alias("group")
    dealt = pieces.select(group, "name", "words").repartition("group").sortWithinPartitions("group", "name", "words")
    dealt.mapInArrow(pack, schema).write.partitionBy("block").parquet(folder)
    keys = spark.read.schema(schema).parquet(folder).select("block").distinct().collect()
    return sorted(f"{folder}/block={r.block}" for r in keys)


def read_block(folder: str) -> list[tuple[str | None, list[bytes]]]:
    """Items of a written block, in whatever store the shared folder is."""
    store, inner = fs.FileSystem.from_uri(folder if ":" in folder.split("/")[0] else f"file://{folder}")
    table = dataset.dataset(inner, filesystem=store, format="parquet").to_table(["name", "words"])
    return list(zip(table["name"].to_pylist(), table["words"].to_pylist(), strict=True))


_AUTOMATA: dict = {}
keeps(__name__, _AUTOMATA.clear)


def _automaton(folder: str | None, width: int) -> SuffixAutomaton:
    """Built once per worker and block from the block's files."""
    key = (folder, width)
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = SuffixAutomaton(read_block(folder) if folder else [], width)
    return _AUTOMATA[key]


def _scan(docs: DataFrame, folder: str | None, width: int) -> DataFrame:
    """Hits of one block (none without a folder): ``docs`` has doc_id, text, row_key."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        automaton = _automaton(folder, width)
        span_type = pa.list_(pa.list_(pa.int32()))
        for batch in batches:
            for part in slices(batch):
                n, spans, found = [], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    words = normalised(text)
                    s, f = automaton.spans(words)
                    n.append(len(words))
                    spans.append(s)
                    found.append(sorted({x for i in f if (x := automaton.names[i]) is not None}))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(spans, span_type),
                     pa.array(found, pa.list_(pa.string()))],
                    names=["doc_id", "row_key", "n_words", "spans", "items"])

    return docs.mapInArrow(run, f"doc_id {kind}, row_key long, n_words long, spans array<array<int>>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: ``doc_id``, ``row_key``, ``n_words``, hit ``spans`` ([start, end) in words, disjoint and
    in order) and ``items`` (ids with occurring windows, sorted)."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         row_key(id_col, text_col).alias("row_key"))
    folders = item_blocks(benchmark, item_col, item_text_col, block_words, width)
    parts = [_scan(picked, folder, width) for folder in folders or [None]]
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        hits = p.filter(F.size("spans") > 0)
        every = every.unionByName(hits)
    # repeated rows share a row_key and equal lists: sets drop the repeats, and the join brings the rows back
    united = every.groupBy("row_key").agg(
        F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merge = F.udf(merged, "array<array<int>>")
    first = parts[0].select("doc_id", "row_key", "n_words")
    return first.join(united, "row_key").select("doc_id", "row_key", "n_words", merge("spans").alias("spans"), "items")


def merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
                  max_percent: int = 80) -> DataFrame:
    """``docs`` without the hit spans; rows and columns stay.

    A span is cut out of the original text, from its first word's start to its last word's end. Where hits
    cover more than ``max_percent`` of a document's words, the rest is not worth keeping and the text becomes
    empty. Texts without hits stay as they are. The hits (few and small) meet the texts again by the row key.
    """
    found = contamination(docs, benchmark, id_col, text_col, item_col, item_text_col, width)
    hits = found.filter(F.size("spans") > 0).groupBy(F.col("row_key").alias("__hit_key")).agg(
        F.first("spans").alias("__spans"), F.first("n_words").alias("__n_words"))
    keyed = docs.withColumn("__row_key", row_key(id_col, text_col))
    joined = keyed.join(hits, F.col("__row_key") == F.col("__hit_key"), "left")

    @F.pandas_udf("string")
    def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    text = (F.when(F.col("__spans").isNull(), F.col(text_col))
            .when(100 * n_hit("__spans") > max_percent * F.col("__n_words"), F.lit(""))
            .otherwise(without(F.col(text_col), F.col("__spans"))))
    return joined.withColumn(text_col, text).drop("__row_key", "__hit_key", "__spans", "__n_words")


def cut(text: str | None, spans) -> str | None:
    """``text`` without the words in ``spans``; what stands before the first and after the last word stays."""
    if text is None or spans is None or not len(spans):
        return text
    raw = text.encode()
    # lower-casing A-Z keeps every byte's place
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:places[a][0]])
        at = places[b - 1][1]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "ignore")

