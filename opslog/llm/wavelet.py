"""Token ids as one wavelet matrix a shard: bit planes with ranks, readable without expanding the file.

File: the planes (highest bit first) in zstd chunks of 2^19 bits, then the documents (ids, ends of
their tokens), then a JSON footer, its length and the magic.  The footer keeps for every chunk its
place and the ones before it, and for every plane its zeros; so a token, the count of an id in a
range, or the place of its k-th occurrence needs one or two chunks a plane.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslog.llm.common import saved, strings, text_bytes
from opslog.llm.tokens import encoder
from opslog.session import scratch_dir

MAGIC = b"WVLTMTX1"
CHUNK_BITS = 1 << 19
SHARD_TOKENS = 1 << 22  # a shard is closed at the first document end beyond this many ids
PART_BYTES = 24_000_000
END_ID = 2


def _levels(ids: np.ndarray) -> int:
    return max(1, int(ids.max()).bit_length()) if len(ids) else 1


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """The file of a shard."""
    levels, pack = _levels(ids), zstandard.ZstdCompressor(level=1)
    x = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    out, at, zeros, chunks = [], 0, [], []
    for level in reversed(range(levels)):
        bits = (x >> x.dtype.type(level)) & x.dtype.type(1)
        ones = bits.astype(bool)
        plane = np.packbits(ones, bitorder="little")
        rows, before = [], 0
        for lo in range(0, max(1, len(plane)), CHUNK_BITS // 8):
            raw = plane[lo : lo + CHUNK_BITS // 8]
            data = pack.compress(raw.tobytes())
            rows.append([at, len(data), before])
            before += int(np.bitwise_count(raw).sum())
            out.append(data)
            at += len(data)
        chunks.append(rows)
        zeros.append(len(x) - before)
        if level:
            x = np.concatenate([np.compress(~ones, x), np.compress(ones, x)])
    known = np.array([d is not None for d in doc_ids], bool)
    values = np.array([d or 0 for d in doc_ids], "<i8")
    docs = pack.compress(known.tobytes() + values.tobytes() + np.cumsum(lengths).astype("<i8").tobytes())
    out.append(docs)
    footer = {"n": len(ids), "levels": levels, "zeros": zeros, "chunks": chunks, "docs": [at, len(docs), len(doc_ids)]}
    tail = json.dumps(footer).encode()
    return b"".join([*out, tail, struct.pack("<I", len(tail)), MAGIC])


class WaveletFile:
    """Reads one shard; ``source`` is anything with ``seek`` and ``read``."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        tail, magic = struct.unpack("<I8s", self._bytes(size - 12, 12))
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        footer = json.loads(self._bytes(size - 12 - tail, tail))
        self.n, self.levels, self.zeros, self.chunks = (footer[k] for k in ("n", "levels", "zeros", "chunks"))
        self._docs = footer["docs"]
        self._kept: dict[tuple[int, int], np.ndarray] = {}

    def _bytes(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def _chunk(self, level: int, k: int) -> np.ndarray:
        if (level, k) not in self._kept:
            if len(self._kept) >= 64:
                self._kept.clear()
            at, length, _ = self.chunks[level][k]
            self._kept[level, k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._bytes(at, length)), np.uint8)
        return self._kept[level, k]

    def _rank1(self, level: int, i: int) -> int:
        """Ones of a plane before place ``i``."""
        if i >= self.n:
            return self.n - self.zeros[level]
        raw, inside = self._chunk(level, i // CHUNK_BITS), i % CHUNK_BITS
        whole = int(np.bitwise_count(raw[: inside // 8]).sum())
        rest = int(raw[inside // 8]) & ((1 << inside % 8) - 1) if inside % 8 else 0
        return self.chunks[level][i // CHUNK_BITS][2] + whole + rest.bit_count()

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) ``bit`` of a plane."""
        rows = self.chunks[level]
        lo, hi = 0, len(rows) - 1
        while lo < hi:
            mid = (lo + hi + 1) // 2
            before = rows[mid][2] if bit else mid * CHUNK_BITS - rows[mid][2]
            lo, hi = (mid, hi) if before <= k else (lo, mid - 1)
        bits = np.unpackbits(self._chunk(level, lo), bitorder="little")
        before = rows[lo][2] if bit else lo * CHUNK_BITS - rows[lo][2]
        return lo * CHUNK_BITS + int(np.flatnonzero(bits == bit)[k - before])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            ones = self._rank1(level, i)
            bit = int(self._chunk(level, i // CHUNK_BITS)[i % CHUNK_BITS // 8]) >> i % 8 & 1
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token < 0 or token.bit_length() > self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in places ``lo`` to ``hi``."""
        a, b = self._range(token, max(0, lo), self.n if hi is None else min(hi, self.n))
        return max(0, b - a)

    def occurrence(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in reversed(range(self.levels)):
            bit = token >> (self.levels - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the documents and the ends of their tokens."""
        at, length, count = self._docs
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(at, length))
        known = np.frombuffer(raw[:count], bool)
        values = np.frombuffer(raw[count : 9 * count], "<i8")
        return [int(v) if k else None for v, k in zip(values, known)], np.frombuffer(raw[9 * count :], "<i8")

    def tokens(self) -> np.ndarray:
        """All ids, rebuilt from the last plane to the first."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        x = np.zeros(self.n, kind)
        for level in reversed(range(self.levels)):
            raw = np.concatenate([self._chunk(level, k) for k in range(len(self.chunks[level]))])
            ones = np.unpackbits(raw, count=self.n, bitorder="little").view(bool)
            y = np.empty_like(x)
            x[self.zeros[level] :] |= kind(1 << (self.levels - 1 - level))
            y[np.flatnonzero(~ones)], y[np.flatnonzero(ones)] = x[: self.zeros[level]], x[self.zeros[level] :]
            x = y
        return x.astype("<u4")


def _store(folder: str, name: str, data: bytes) -> str:
    """Writes under a name of its own, then renames: a repeated task leaves one whole file."""
    fs, path = pafs.FileSystem.from_uri(folder)
    part = f"{path}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as f:
        f.write(data)
    fs.move(part, f"{path}/{name}")
    return f"{folder}/{name}"


def _write_shards(folder: str, tokenizer: str, spaced: bool, shard_tokens: int):
    def run(batches):
        model, task = encoder(tokenizer, spaced), None
        ids: list[np.ndarray] = []
        docs: list[int | None] = []
        count, shard = 0, 0

        def close():
            nonlocal ids, docs, count, shard
            lengths = np.array([len(x) for x in ids], np.int64)
            path = _store(folder, f"part-{task:06d}-{shard:06d}.wvm", build(np.concatenate(ids), docs, lengths))
            row = pa.RecordBatch.from_pydict({"task": [task], "shard": [shard], "path": [path], "n_tokens": [count]})
            ids, docs, count, shard = [], [], 0, shard + 1
            return row

        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4")
        for batch in batches:
            for doc, own in zip(batch.column(0).to_pylist(), model.encode_all(strings(batch, "text"))):
                x = np.concatenate([own, end])
                ids.append(x)
                docs.append(doc)
                count += len(x)
                if count >= shard_tokens:
                    yield close()
        if docs:
            yield close()

    return run


def write_shards(
    documents: DataFrame,
    folder: str,
    tokenizer: str = "word_bpe_49k.json",
    spaced: bool = False,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encodes ``text`` and writes the shards below ``folder`` (a URI that all executors reach).

    Returns the manifest: path, n_tokens and start (ids before the shard) in ascending order of
    documents.  Null ids come first; a null text is empty and holds its end id only.
    """
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tasks = max(1, -(-text_bytes(docs) // PART_BYTES))
    ordered = docs.repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(
        _write_shards(folder, tokenizer, spaced, shard_tokens), "task bigint, shard bigint, path string, n_tokens bigint"
    )
    manifest = saved(made, "manifest")
    # One row a shard: a few million for a petabyte of text.
    before = Window.orderBy("task", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("path", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint").alias("start"))


def _read_shards(batches):
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = pafs.FileSystem.from_uri(row["path"])
            with fs.open_input_file(path) as source:
                shard = WaveletFile(source)
                docs, ends = shard.documents()
                data = memoryview(shard.tokens().tobytes())
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(docs, pa.int64()),
                    "start": pa.array(starts + row["start"]),
                    "n_tokens": pa.array(ends - starts),
                    "ids_crc32": pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()),
                }
            )


def read_shards(manifest: DataFrame) -> DataFrame:
    """Documents of the shards: doc_id, start, n_tokens, ids_crc32."""
    rows = manifest.repartition(max(1, manifest.count()), "path")
    return rows.mapInArrow(_read_shards, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def shard_folder(spark: SparkSession) -> str:
    folder = scratch_dir(spark, "wavelet")
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
