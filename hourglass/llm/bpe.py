"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside every task.

A slice of texts is cut at the spaces that the vocabulary's pattern never joins over, and its distinct pieces are told
by Arrow. Those that the worker does not know are split into pre-tokens by the pattern. The distinct new pre-tokens
become token-position rows, one per byte; a recursive query joins neighbouring positions with the merge table, contracts
each word's leftmost pair of minimum rank, and goes on until no word has a pair left. An ordered aggregation over the
vocabulary's bytes decodes every word's ids. The worker keeps both, ids and decoded bytes, once per distinct piece in
a bounded Arrow table; a text's ids and its decoded bytes are those of its pieces, in the same order. A word that is a
vocabulary entry as a whole has that one id without a merge.

A word's recursion holds rows in the square of its length, so words of more than ``LONG_WORD`` bytes (not
seen in prose) run the same merges from a heap instead.

Defined results: a null text counts as empty (no ids, no bytes); repeated rows are encoded each; an empty
table gives an empty table; other columns are ignored. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.text import enter, keeps, slices

RANKS = "byte_bpe_50k.tiktoken"
LONG_WORD = 256
#: Bytes of a worker's table of pieces (some 50 a piece) above which it drops those that did not come again.
TABLE_BYTES = 16 << 20
#: Bytes of the texts that are told apart together.
SLICE_BYTES = 4 << 20
#: Words of one recursive query.
QUERY_WORDS = 20_000
#: A word's entry is one string: every id after a space, in byte values that UTF-8 does not have, and after it the bytes
#: that the id decodes to. So a text's entries are joined once, and two byte tables part ids and bytes again.
PLAIN, CODED = b"0123456789 ", bytes(range(0xF5, 0x100))
_CODE, _PLAIN = bytes.maketrans(PLAIN, CODED), bytes.maketrans(CODED, PLAIN)
_NOT_CODED = bytes(set(range(256)) - set(CODED))

_SPLIT = regex.compile(public_tokenizers.PATTERN)
#: A space between two characters that are not white space: the pattern starts a pre-token with it, whatever is around.
_CUT = regex.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = regex.compile(r"(?<!\S) | (?!\S)")

#: ``spot`` packs word and position. Each step keeps the rows of the words that still have a pair.
MERGE_SQL = """
WITH RECURSIVE parts(step, spot, tok) AS (
  SELECT 0, (w::BIGINT << 24) + pos, tok FROM word_bytes
UNION ALL (
  WITH near AS MATERIALIZED (
    SELECT step, spot, tok, lead(tok) OVER x AS right_tok, lead(spot) OVER x AS right_spot
    FROM parts WINDOW x AS (ORDER BY spot)),
  best AS MATERIALIZED (
    SELECT n.spot >> 24 AS w, min((m.merged << 40) + ((n.spot & 1048575) << 20) + (n.right_spot & 1048575)) AS k
    FROM near n JOIN merges m ON m.l = n.tok AND m.r = n.right_tok AND n.spot >> 24 = n.right_spot >> 24 GROUP BY 1),
  pick AS MATERIALIZED (
    SELECT w, (w << 24) + ((k >> 20) & 1048575) AS spot, (w << 24) + (k & 1048575) AS gone, (k >> 40)::INTEGER AS merged
    FROM best)
  SELECT n.step + 1, n.spot, CASE WHEN n.spot = p.spot THEN p.merged ELSE n.tok END
  FROM near n JOIN pick p ON n.spot >> 24 = p.w
  WHERE n.spot <> p.gone)),
done AS (SELECT spot >> 24 AS w, max(step) AS step FROM parts GROUP BY 1)
SELECT d.w AS w, p.spot & 16777215 AS pos, p.tok AS tok
FROM parts p JOIN done d ON p.spot >> 24 = d.w AND p.step = d.step
"""

DECODE_SQL = """
SELECT t.w AS w, from_hex(string_agg(v.hex, '' ORDER BY t.pos)) AS bytes
FROM word_tokens t JOIN vocabulary v ON v.id = t.tok GROUP BY t.w
"""

#: All words' entries in one ordered aggregation, each after a byte (C0) that neither UTF-8 nor an id has.
ENTRY_SQL = """
SELECT from_hex(string_agg(CASE WHEN t.pos = 0 THEN 'C0' ELSE '' END || v.coded || v.hex, '' ORDER BY t.w, t.pos)) AS entries
FROM word_tokens t JOIN vocabulary v ON v.id = t.tok
"""


def _indices(found: pa.Array) -> np.ndarray:
    """Places found by ``index_in``, -1 where there is none."""
    return found.fill_null(-1).to_numpy()


def _cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(rows, their numbers of pieces, the pieces): first the texts all of whose spaces are cut, then the others."""
    whole, odd, pieces = [], [], []
    for i, text in enumerate(texts.to_pylist()):
        if len(" ".join(text.split())) == len(text) or not _OTHER_SPACE.search(text):
            whole.append(i)
        else:
            odd.append(i)
            pieces.append(_CUT.split(text))
    even = pc.split_pattern(texts.take(pa.array(whole, pa.int64())), " ")
    n = np.concatenate([pc.list_value_length(even).to_numpy(), np.array([len(x) for x in pieces], np.int64)])
    return (np.array(whole + odd, np.int64), n.astype(np.int64),
            pa.concat_arrays([even.flatten(), pa.array([p for x in pieces for p in x], pa.large_string())]))


def _join(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    """Runs of the given lengths, each joined."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), pa.scalar(b"", values.type))


class Pieces:
    """Ids and decoded bytes of the pieces that a worker knows."""

    def __init__(self):
        self.names = pa.array([], pa.large_string())
        self.entries = pa.array([], pa.large_binary())
        #: the slice that last met the piece again, 0 if none did
        self.met = np.zeros(0, np.int64)
        self.slice = 0

    def size(self) -> int:
        return self.names.nbytes + self.entries.nbytes

    def age(self) -> None:
        """Start of a slice. A full table keeps what came again; if that is over half, what the last slice met again, or nothing."""
        if self.size() > TABLE_BYTES:
            for least in (1, self.slice, self.slice + 1):
                if self.size() > TABLE_BYTES // 2:
                    self._keep(self.met >= least)
            self.met[:] = 0
        self.slice += 1

    def _keep(self, mask: np.ndarray) -> None:
        keep = pa.array(mask)
        self.names, self.entries, self.met = self.names.filter(keep), self.entries.filter(keep), self.met[mask]

    def find(self, names: pa.Array) -> np.ndarray:
        at = _indices(pc.index_in(names, value_set=self.names))
        self.met[at[at >= 0]] = self.slice
        return at

    def add(self, names: pa.Array, entries: pa.Array) -> None:
        self.names = pa.concat_arrays([self.names, names])
        self.entries = pa.concat_arrays([self.entries, entries])
        self.met = np.concatenate([self.met, np.zeros(len(names), np.int64)])


class Vocabulary:
    """Ranks, the merge table and a DuckDB connection; once per worker."""

    def __init__(self, rank_file: bytes):
        import duckdb

        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines())}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(a, b, r) for t, r in self.ranks.items() for i in range(1, len(t))
                 if (a := self.ranks.get(t[:i])) is not None and (b := self.ranks.get(t[i:])) is not None]
        left, right, merged = zip(*pairs, strict=True)
        self.con = duckdb.connect()
        self.con.execute("SET threads = 1")
        self.con.execute("SET memory_limit = '256MB'")
        self.con.register("given", pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()),
                                             "merged": pa.array(merged, pa.int64())}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.con.register("given", pa.table({"id": pa.array(self.ranks.values(), pa.int32()),
                                             "coded": [(b" %d" % r).translate(_CODE).hex() for r in self.ranks.values()],
                                             "hex": [t.hex() for t in self.ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.con.unregister("given")
        #: ids whose bytes no UTF-8 text has
        self.odd = np.zeros(max(self.ranks.values()) + 1, bool)
        self.odd[[r for t, r in self.ranks.items() if t.translate(None, b"\xc0" + CODED) != t]] = True
        self.whole, self.whole_ids = pa.array(self.ranks, pa.large_binary()), np.fromiter(self.ranks.values(), np.int32)
        self.pieces = Pieces()

    def merge(self, words: list[bytes]) -> pa.Table:
        """Token-position rows (w, pos, tok) of the words' fixpoint, by the recursive query."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        self.con.register("word_bytes", pa.table({
            "w": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "pos": (np.arange(len(raw)) - np.repeat(starts, lengths)).astype(np.int32), "tok": self.byte_ids[raw]}))
        return self.con.sql(MERGE_SQL).to_arrow_table()

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges for a long word: a heap of (rank, position) over linked positions."""
        rank_of = self.ranks.get
        ends = list(range(1, len(word) + 1))
        before = list(range(-1, len(word) - 1))
        alive = [True] * len(word)

        def push(a: int) -> None:
            b = ends[a]
            if b < len(word) and (r := rank_of(word[a:ends[b]])) is not None:
                heapq.heappush(heap, (r, a, b, ends[b]))

        heap: list[tuple[int, int, int, int]] = []
        for a in range(len(word)):
            push(a)
        while heap:
            _, a, b, end = heapq.heappop(heap)
            if not alive[a] or ends[a] != b or not alive[b] or ends[b] != end:
                continue
            alive[b] = False
            ends[a] = end
            if end < len(word):
                before[end] = a
            push(a)
            if before[a] >= 0:
                push(before[a])
        out, a = [], 0
        while a < len(word):
            out.append(self.ranks[word[a:ends[a]]])
            a = ends[a]
        return out

    def learn(self, words: pa.Array) -> pa.Array:
        """Entries of distinct pre-tokens: ids from the merges, bytes from the ordered aggregation."""
        out = [pa.array([], pa.large_binary())]
        for at in range(0, len(words), QUERY_WORDS):
            part = words.slice(at, QUERY_WORDS).cast(pa.large_binary())
            whole = _indices(pc.index_in(part, value_set=self.whole))
            long = (pc.binary_length(part).to_numpy() > LONG_WORD) & (whole < 0)
            single = np.flatnonzero(whole >= 0)
            w, pos, tok = [single], [np.zeros(len(single), np.int64)], [self.whole_ids[whole[single]]]
            for i in np.flatnonzero(long):
                ids = self.merge_long(part[i].as_py())
                w.append(np.full(len(ids), i))
                pos.append(np.arange(len(ids)))
                tok.append(np.array(ids, np.int32))
            plain = np.flatnonzero((whole < 0) & ~long)
            if len(plain):
                t = self.merge(part.take(pa.array(plain)).to_pylist())
                w.append(plain[t["w"].to_numpy()])
                pos.append(t["pos"].to_numpy())
                tok.append(t["tok"].to_numpy())
            ids = np.concatenate(tok)
            if self.odd[ids].any():
                raise ValueError("ids of words decode to bytes that are not UTF-8")
            self.con.register("word_tokens", pa.table({"w": np.concatenate(w), "pos": np.concatenate(pos), "tok": ids}))
            raw = np.frombuffer(self.con.sql(ENTRY_SQL).to_arrow_table()["entries"][0].as_py(), np.uint8)
            heads = raw == 0xC0
            starts = np.flatnonzero(heads)
            if len(starts) != len(part):
                raise ValueError("words without ids")
            data = raw[~heads]
            offsets = np.append(starts - np.arange(len(starts)), len(data)).astype(np.int64)
            out.append(pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
        return pa.concat_arrays(out)

    def decode(self, ids: list[list[int] | None]) -> list[bytes]:
        """Each list's bytes by one ordered aggregation; an unknown id has no bytes."""
        lengths = [len(x) if x is not None else 0 for x in ids]
        flat = np.concatenate([np.asarray(x, np.int32) for x in ids if x is not None and len(x)] or [np.empty(0, np.int32)])
        self.con.register("word_tokens", pa.table({
            "w": np.repeat(np.arange(len(ids), dtype=np.int64), lengths), "pos": np.arange(len(flat)), "tok": flat}))
        found = {w: bytes(b) for w, b in self.con.execute(DECODE_SQL).fetchall()}
        return [found.get(i, b"") for i in range(len(ids))]

    def enter(self, names: pa.Array) -> pa.Array:
        """Entries of distinct new pieces, which the table then knows, and their pre-tokens."""
        several: dict[int, list[str]] = {}
        for i, p in enumerate(names.to_pylist()):
            if not (p[1:] if p[:1] == " " else p).isalpha() and len(tokens := _SPLIT.findall(p)) != 1:
                several[i] = tokens
        mixed = np.fromiter(several, np.int64, len(several))
        alone = np.ones(len(names), bool)
        alone[mixed] = False
        tokens = pa.array([t for x in several.values() for t in x], pa.large_string()).dictionary_encode()
        known = self.pieces.find(tokens.dictionary)
        words = pa.concat_arrays([names.filter(pa.array(alone)), tokens.dictionary.filter(pa.array(known < 0))]).unique()
        learnt = self.learn(words)
        of_token = np.where(known >= 0, known, len(self.pieces.entries) + _indices(pc.index_in(tokens.dictionary, value_set=words)))
        joined = _join(pa.concat_arrays([self.pieces.entries, learnt]).take(pa.array(of_token[tokens.indices.to_numpy()])),
                       np.array([len(x) for x in several.values()], np.int64))
        place = np.empty(len(names), np.int64)
        place[alone] = _indices(pc.index_in(names.filter(pa.array(alone)), value_set=words))
        place[mixed] = len(words) + np.arange(len(mixed))
        self.pieces.add(words, learnt)
        self.pieces.add(names.take(pa.array(mixed)), joined)
        return pa.concat_arrays([learnt, joined]).take(pa.array(place))

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """(ids joined by spaces, bytes that they decode to) of every text."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        self.pieces.age()
        rows, n, pieces = _cut(texts.fill_null(""))
        # a text's first piece as it is, the others behind their space
        first = np.zeros(len(pieces), bool)
        first[np.cumsum(n) - n] = True
        led = pieces.filter(pa.array(~first)).dictionary_encode()
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), led.dictionary, pa.scalar(" ", pa.large_string()))
        names = pa.concat_arrays([spaced, pieces.filter(pa.array(first))]).dictionary_encode()
        of_name = names.indices.to_numpy()
        index = np.empty(len(pieces), np.int64)
        index[~first] = of_name[:len(spaced)][led.indices.to_numpy()]
        index[first] = of_name[len(spaced):]
        at = self.pieces.find(names.dictionary)
        entries = self.pieces.entries
        new = self.enter(names.dictionary.filter(pa.array(at < 0)))
        at = np.where(at < 0, len(entries) + np.cumsum(at < 0) - 1, at)
        joined = _join(pa.concat_arrays([entries, new]).take(pa.array(at[index])), n)
        for entry in joined.take(pa.array(np.argsort(rows))).to_pylist():
            yield entry.translate(_PLAIN, _NOT_CODED)[1:], entry.translate(None, CODED)


_VOCABULARIES: dict[int, tuple[Vocabulary, object]] = {}
keeps(__name__, _VOCABULARIES.clear)


def _vocabulary(ranks) -> Vocabulary:
    """``ranks``: the broadcast bytes of a rank file (under 1 MB)."""
    if id(ranks) not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[id(ranks)] = Vocabulary(ranks.value), ranks
    return _VOCABULARIES[id(ranks)][0]


def rank_file(spark, path: str | None = None):
    """The rank file at ``path``, broadcast."""
    with open(path or public_tokenizers.path(RANKS), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           with_ids: bool = True) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one space),
    ``decoded_sha256`` (of the bytes that the ids decode to) and, if asked for, ``ids``."""
    ranks = rank_file(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        vocabulary = _vocabulary(ranks)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                ids, n, a, b = [], [], [], []
                for joined, decoded in vocabulary.encode(part.column(1)):
                    n.append(joined.count(b" ") + 1 if joined else 0)
                    a.append(hashlib.sha256(joined).hexdigest())
                    b.append(hashlib.sha256(decoded).hexdigest())
                    if with_ids:
                        ids.append(np.array(joined.split(), np.int32))
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Per row: ``doc_id`` and ``text``, the decoded bytes as UTF-8 (bad sequences replaced)."""
    ranks = rank_file(tokens.sparkSession, path)
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        vocabulary = _vocabulary(ranks)
        for batch in batches:
            for part in slices(batch):
                texts = [b.decode("utf-8", "replace") for b in vocabulary.decode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"doc_id {kind}, text string")
