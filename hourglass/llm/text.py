"""Small helpers shared by the operators: row keys, Arrow batches, word hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries that a worker keeps in a word table before it starts a new one.
TABLE_ENTRIES = 1 << 16


def row_key(id_col: str, text_col: str) -> Column:
    """A key made of the row's content, so it is the same in every run of a lost task. Rows that are equal
    in id and text share it, and share every decision."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def map_batches(df: DataFrame, schema: str, rows: Callable[[list[list]], list[list]]) -> DataFrame:
    """``rows`` turns the columns of an Arrow batch (as lists, strings as UTF-8 bytes) into output columns."""
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(target)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(rows(columns(part)), out, strict=True)], schema=out)

    return df.mapInArrow(run, target)


def slices(batch: pa.RecordBatch, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most_bytes`` (single rows may be larger), so Python objects stay few."""
    n = batch.num_rows
    step = max(1, int(n * most_bytes / max(batch.nbytes, 1)))
    for at in range(0, n, step):
        yield batch.slice(at, min(step, n - at))


def columns(batch: pa.RecordBatch) -> list[list]:
    return [(c.cast(pa.binary()) if pa.types.is_string(c.type) else c).to_pylist() for c in batch.columns]


#: What the operators keep in a worker between tasks: owner -> how to drop it.
_KEPT: dict[str, Callable[[], None]] = {}
#: The owner of the worker's last task.
_LAST: list[str] = []


def keeps(owner: str, drop: Callable[[], None]) -> None:
    """``owner`` (a module) keeps tables in its workers; ``drop`` empties them."""
    _KEPT[owner] = drop


def enter(owner: str) -> None:
    """Start of a task of ``owner``: a reused worker drops what other operators kept in it, and gives the memory back,
    so that the stages of a pipeline do not add up in memory."""
    if _LAST == [owner]:
        return
    for other, drop in _KEPT.items():
        if other != owner:
            drop()
    _LAST[:] = [owner]
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


class WordHashes(dict):
    """64-bit hashes of words (bytes), computed once per word while the table is below its bound."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)
        if len(self) < TABLE_ENTRIES:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def signed(h: int) -> int:
    """An unsigned 64-bit hash as Spark's long."""
    return h - (1 << 64) if h >= 1 << 63 else h


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a multiply-xorshift finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h
