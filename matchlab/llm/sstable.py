"""Token-id shards as sorted string tables.

A shard holds documents in ascending key order: prefix-compressed blocks, a sparse block index (first key, offset,
length), a Bloom filter over the keys and a fixed footer. A reader finds one document with a binary search in the
index and one block read; a scan reads the blocks in order.

Edge cases: a null text is an empty one (only the end id is stored); a null doc_id sorts first; rows that repeat a
doc_id are all stored, ordered by the hash of their text; an empty table gives no shards; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import column, keyed, scratch, staged, text_chunks
from .tokens import crc, encoder

MAGIC = b"TOKSST01"
FOOTER = struct.Struct("<QQQQQQ8s")  # index offset, index bytes, Bloom offset, Bloom bytes, documents, ids, magic
ENTRY = struct.Struct("<BBI")  # shared key bytes, further key bytes, value bytes
BLOCK_BYTES = 64 * 1024
BLOOM_BITS = 10  # per key
BLOOM_HASHES = 7


def key_of(doc_id: int | None) -> bytes:
    """Keys compare as the ids do; a null is the empty key."""
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def id_of(key: bytes) -> int | None:
    return None if not key else struct.unpack(">Q", key)[0] - (1 << 63)


def _bits(key: bytes, size: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & ((1 << 64) - 1), (h >> 64) | 1
    return [(a + i * b) % size for i in range(BLOOM_HASHES)]


class Writer:
    """Takes (doc_id, ids) in ascending order. Blocks are written as they fill; index and filter at the end."""

    def __init__(self, out, width: str = "<u2"):
        self.out, self.width = out, width
        self.at = self.docs = self.ids = 0
        self.block = bytearray()
        self.index: list[tuple[bytes, int, int]] = []
        self.first = self.last = None
        self.keys: list[bytes] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        key, value = key_of(doc_id), np.ascontiguousarray(ids, self.width).tobytes()
        if self.first is None:
            self.first, self.last = key, b""
        shared = 0
        while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        self.block += ENTRY.pack(shared, len(key) - shared, len(value)) + key[shared:] + value
        self.last = key
        self.docs += 1
        self.ids += len(ids)
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            data = zlib.compress(bytes(self.block), 1)
            self.out.write(data)
            self.index.append((self.first, self.at, len(data)))
            self.at += len(data)
            self.block = bytearray()
            self.first = None

    def close(self) -> None:
        self.flush()
        index = struct.pack("<I2s", len(self.index), self.width[1:].encode()) + b"".join(struct.pack("<BQI", len(k), o, n) + k for k, o, n in self.index)
        size = max(64, BLOOM_BITS * len(self.keys))
        bits = np.zeros((size + 7) // 8, np.uint8)
        for k in self.keys:
            for x in _bits(k, size):
                bits[x >> 3] |= 1 << (x & 7)
        bloom = struct.pack("<Q", size) + bits.tobytes()
        self.out.write(index + bloom)
        self.out.write(FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), self.docs, self.ids, MAGIC))


class Reader:
    """source: a seekable binary file."""

    def __init__(self, source):
        self.f = source
        end = source.seek(0, 2)
        source.seek(end - FOOTER.size)
        io, isz, bo, bsz, self.docs, self.ids, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        source.seek(io)
        raw = source.read(isz)
        n, width = struct.unpack_from("<I2s", raw)
        self.width, at, self.keys, self.at = "<" + width.decode(), 6, [], []
        for _ in range(n):
            k, o, size = struct.unpack_from("<BQI", raw, at)
            at += 13
            self.keys.append(raw[at : at + k])
            self.at.append((o, size))
            at += k
        source.seek(bo)
        raw = source.read(bsz)
        self.bloom_bits = struct.unpack_from("<Q", raw)[0]
        self.bloom = raw[8:]

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        o, n = self.at[i]
        self.f.seek(o)
        raw, at, key = zlib.decompress(self.f.read(n)), 0, b""
        while at < len(raw):
            shared, more, size = ENTRY.unpack_from(raw, at)
            at += ENTRY.size
            key = key[:shared] + raw[at : at + more]
            at += more
            yield key, np.frombuffer(raw, self.width, size // int(self.width[2:]), at)
            at += size

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(len(self.at)):
            for k, v in self.block(i):
                yield id_of(k), v

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every row with that doc_id; usually one block is read, none where the filter says no."""
        key = key_of(doc_id)
        if any(not self.bloom[x >> 3] >> (x & 7) & 1 for x in _bits(key, self.bloom_bits)):
            return []
        i = max(0, bisect_right(self.keys, key) - 1)
        while i > 0 and self.keys[i] == key:
            i -= 1
        found = []
        for j in range(i, len(self.keys)):
            if self.keys[j] > key:
                break
            found += [v for k, v in self.block(j) if k == key]
        return found


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str, shards: int | None = None) -> DataFrame:
    """Encode and write every text, in ascending doc_id order over the shards.

    Returns the shards' table (shard, file, docs, ids, base): base counts the ids of all shards before. File names
    carry the task's attempt, so a repeated task never touches another's file; the table names those that count.
    """
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed(docs).repartitionByRange(n, "doc_id", "th").sortWithinPartitions("doc_id", "th")

    def write(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        enc, w, name, out = encoder(tokenizer), None, "", None
        wide = enc.tok.get_vocab_size() >= 1 << 16 or end_id >= 1 << 16
        for b, texts in text_chunks(batches):
            ids, lens = enc.encode(texts)
            if w is None:
                fs.create_dir(base, recursive=True)
                name = f"{base}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.sst"
                out = fs.open_output_stream(name)
                w = Writer(out, "<u4" if wide else "<u2")
            ends = np.cumsum(lens)
            for doc_id, e, k in zip(column(b, "doc_id").to_pylist(), ends, lens):
                w.add(doc_id, np.append(ids[e - k : e], np.uint32(end_id)))
        if w is not None:
            w.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"shard": TaskContext.get().partitionId(), "file": name, "docs": w.docs, "ids": w.ids}], schema=pa.schema([("shard", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    table = staged(rows.mapInArrow(write, "shard long, file string, docs long, ids long"), "op8-shards")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    return table.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_shards(shards: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, read back from the files."""
    n = max(1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def read(batches):
        fs, _ = pafs.FileSystem.from_uri(path)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for b in batches:
            for s in b.to_pylist():
                with fs.open_input_file(s["file"]) as f:
                    at, rows = s["base"], []
                    for doc_id, ids in Reader(f).scan():
                        rows.append({"doc_id": doc_id, "start": at, "n_tokens": len(ids), "ids_crc32": crc(ids)})
                        at += len(ids)
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return shards.select("shard", "file", "base").repartition(n, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    path = scratch(docs.sparkSession, "op8-files")
    return read_shards(write_shards(docs, tokenizer, end_id, path), path)
