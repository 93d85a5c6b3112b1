"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import itertools
import os
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.session import scratch_dir

CACHE_WORDS = 200_000
_HELD: dict[Any, Any] = {}


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file; ``OPSLOG_TOKENIZERS`` may name another folder."""
    folder = os.environ.get("OPSLOG_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def forget_half(cache: dict) -> None:
    """Drop the older half of a cache's entries."""
    for key in list(itertools.islice(cache, (len(cache) + 1) // 2)):
        del cache[key]


def held(key: Any, make: Callable[[], Any]) -> Any:
    """The worker process's object of this key, made once; the object of another key is dropped.

    Workers outlive tasks and queries, so that what one operator keeps would lie beside what the next one needs.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def give_back() -> None:
    """Return freed memory to the system; the allocators would keep it for the worker's next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable, holds: bool = False) -> Callable:
    """``run`` for ``mapInArrow``, leaving no memory behind in the worker; ``holds`` keeps what ``held`` has."""

    def tidied(batches):
        if not holds:
            _HELD.clear()
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """The same for ``applyInArrow``: after each group."""

    def tidied(table: pa.Table) -> pa.Table:
        _HELD.clear()
        try:
            return run(table)
        finally:
            give_back()

    return tidied


def pieces_of(batch: pa.RecordBatch, column: str = "text", rows: int = 5000, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most so many rows and, beyond one row, so many bytes of text."""
    lengths = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = min(lo + rows, max(lo + 1, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(lo, hi - lo)
        lo = hi


class WordHash(dict):
    """64-bit hash of a word's bytes, computed once per word and forgotten when the memory is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            forget_half(self)
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with full avalanche (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words_of(text: str | None) -> list[bytes]:
    """Words of non-space bytes; only A-Z are lower-cased, only ASCII white space parts words."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def strings(batch: pa.RecordBatch, column: str) -> Iterator[str | None]:
    """The values of a text column, one Python string at a time."""
    return (v.as_py() for v in batch.column(batch.schema.get_field_index(column)))


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores added where a column has one already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_rows(df: DataFrame, choose: Callable[[], Callable[[list[str | None]], np.ndarray]], column: str = "text", rows: int = 500) -> DataFrame:
    """Rows of ``df`` with all columns, whose text the chooser (made once a task) says to keep."""

    def run(batches):
        chosen = choose()
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                yield part.filter(pa.array(np.asarray(chosen(list(strings(part, column))), bool)))

    return df.mapInArrow(tidy(run, holds=True), df.schema)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Total bytes of a text column: what task counts are derived from."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def parts_for(total: int, each: int, least: int = 8) -> int:
    """A power of two of parts, so that one holds about ``each`` of ``total``."""
    parts = least
    while parts * each < total:
        parts *= 2
    return parts
