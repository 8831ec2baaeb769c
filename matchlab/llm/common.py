"""Shared pieces of the corpus operators: scratch tables, bounded text chunks, word codes and hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: list[str] = []

#: Bytes of an Arrow batch that Spark hands to a task's Python; of text that it works on at once.
BATCH_BYTES = 16 << 20
CHUNK_BYTES = 4_000_000

#: Spark's setting that deletes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new local one where it is unset (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-"))
    return _own_dir[0]


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    return staged_all([df], label)


def staged_all(parts: Iterable[DataFrame], label: str, *by: str) -> DataFrame:
    """As staged, of tables alike in their columns that are written one after another: the shuffle files of one go before
    the next is begun. by: last columns, by whose values the files are split, so that a filter on them skips files."""
    path = schema = spark = None
    for df in parts:
        if path is None:
            spark, path, schema = df.sparkSession, scratch(df.sparkSession, label), df.schema
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")  # the table is written: no later plan reads its shuffles
        try:
            df.write.mode("append").partitionBy(*by).option("compression", "zstd").parquet(path)
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        at = jvm.org.apache.hadoop.fs.Path(df._scratch)
        at.getFileSystem(conf).delete(at, True)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text), in Arrow batches of bounded size whatever the texts' lengths. th tells rows of one doc_id with different texts apart; rows alike in both are alike in every result."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))


def same_key(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES, column: str = "text"):
    """Slices of the batches with at most about `limit` bytes of text, and their texts as bytes (null: empty)."""
    for b in batches:
        col = b.column(b.schema.get_field_index(column)).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = np.cumsum(sizes + 16) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for s, e in zip(cuts, cuts[1:]):
            if e > s:
                yield b.slice(s, e - s), [x or b"" for x in col.slice(s, e - s).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def word_codes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of all words, number of words of each text, distinct words). A word is a run of bytes other than space and 0x09-0x0D."""
    words: list[bytes] = []
    counts = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = (t.lower() if lower else t).split()
        counts[i] = len(w)
        words += w
    if not words:
        return np.empty(0, np.int64), counts, np.empty(0, object)
    arr = np.empty(len(words), object)
    arr[:] = words
    codes, uniq = pd.factorize(arr)
    return codes, counts, uniq


def hash_words(uniq) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in uniq), np.uint64, len(uniq))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def rolling(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums S and inverse powers, so that (S[j]-S[i])*inv[i] is a polynomial hash of h[i:j] modulo 2^64."""
    n = len(h) + 1
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    s = np.zeros(n, np.uint64)
    np.cumsum(h * _powers[0][: n - 1], out=s[1:], dtype=np.uint64)
    return s, _powers[1][:n]


def slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start..start+length-1 of every slice, one after another."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(first - starts, lengths)


def sort_within(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """x with each run of `counts` values sorted: short runs stay in the processor's cache, unlike a sort by two keys."""
    out, ends = x.copy(), np.cumsum(counts)
    for a, e in zip((ends - counts).tolist(), ends.tolist()):
        out[a:e].sort()
    return out


def shingle_sets(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number per text): each text's sorted distinct `size`-word shingles, A-Z lowered; a shorter text is one shingle, an empty one none."""
    codes, counts, uniq = word_codes(texts, lower=True)
    h = hash_words(uniq)[codes] if len(codes) else np.empty(0, np.uint64)
    s, inv = rolling(h)
    first = np.cumsum(counts) - counts
    width = np.minimum(counts, size)
    n = np.where(counts > 0, counts - width + 1, 0)
    at = slices(first, n)
    doc = np.repeat(np.arange(len(texts)), n)
    g = sort_within(mix((s[at + width[doc]] - s[at]) * inv[at] + width[doc].astype(np.uint64)), n)
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return g[keep], np.bincount(doc[keep], minlength=len(texts)).astype(np.int64)
