"""Spelling variants by dynamic programming over the sorted vocabulary.

The vocabulary is counted in tasks and summed, then written as shards of the sorted word list. A batch of words is held
against a list by one scan of it: neighbouring words share their prefix (adjacent longest common prefixes), so the
edit-matrix row of a prefix is computed once for all words that share it; of each row only the three cells that one
edit can reach are kept, and a range of words is skipped once all three exceed one edit. The same scan over the sorted
list of all three-letter prefixes (at most 90 to the third) tells to which shards a word must go. Scans run depth by
depth for a whole batch of words at once, as numpy columns of (prefix, word) pairs.

Each word's form is its most frequent near word of at least twice its count, so chains of forms at least double at every
step; roots are found by joins that double the steps taken.

Edge cases: a null text has no words; a null id counts as an empty one in the hash; rows that repeat an id count each;
words of any length are compared whole; a table without words gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, discard, keyed, slices, staged, text_chunks

#: Letters in Latin-1, A-Z lowered; every other byte becomes a space.
_FOLD = bytes(b if 97 <= b <= 122 or b >= 0xC0 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: Distinct words that a task counts before it hands them on; words of a list shard, and of a batch held against it.
HELD = 500_000
SHARD = 16_384
BATCH = 4096
PREFIX = 3
FAR = np.uint8(3)


def count_words(docs: DataFrame, least_length: int = 5, modulus: int = 97) -> DataFrame:
    """(word, n): letter runs, A-Z lowered, each less one letter where the hash of id and run asks for it."""

    def run(batches):
        held: dict[bytes, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for b, texts in text_chunks(batches):
            for doc, t in zip(column(b, "doc_id").to_pylist(), texts):
                start = crc32(b"%d:" % doc if doc is not None else b":")
                for w, n in Counter(t.decode("utf-8", "replace").encode("latin-1", "replace").translate(_FOLD).split()).items():
                    if len(w) < least_length:
                        continue
                    h = crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                    if h % modulus == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1 :]
                        if len(w) < least_length:
                            continue
                    held[w] = held.get(w, 0) + n
            if len(held) > HELD:
                yield out()
                held.clear()
        yield out()

    return keyed(docs).select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _common(a: bytes, b: bytes) -> int:
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return m
    lo, hi = 0, m  # a[:lo] equals b[:lo], a[:hi] doesn't
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


class WordList:
    """Sorted distinct words in Latin-1, with the longest common prefix of each word and the one before it."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(words), np.uint8)
        self.lcp = np.array([-1, *map(_common, words, words[1:])][: len(words)], np.int64)
        self._levels: dict[int, tuple] = {}

    def level(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """First and end of each range of words that share their first d letters."""
        if d not in self._levels:
            borders = np.append(np.flatnonzero(self.lcp < d), len(self.words))
            first = borders[:-1][self.size[borders[:-1]] >= d]
            self._levels[d] = first, borders[np.searchsorted(borders, first, side="right")]
        return self._levels[d]


class Batch:
    """Words to look up, with zeros around each so that letters beside it can be read."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.flat = np.frombuffer(b"".join(b"\0" + w + b"\0\0\0\0" for w in words), np.uint8)
        self.start = np.cumsum(self.size + 5) - self.size - 4


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter leads from a to b."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = _common(a, b)
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def scan(words: WordList, batch: Batch, prefixes: bool = False, few: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """(number in the batch, number in the list) of all pairs one edit apart; with `prefixes`, of all pairs whose list
    entry can still begin such a word. Once fewer than `few` words are left in live ranges, they are compared at once."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    n = len(batch.size)
    q, node, d = np.arange(n), np.zeros(n, np.int64), 0
    # cells of the row of a prefix of d letters, against d - 1, d and d + 1 letters of the batch's word
    row = np.full(n, FAR), np.zeros(n, np.uint8), np.where(batch.size >= 1, np.uint8(1), FAR)
    if not len(words.words):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    while len(q):
        first, end = words.level(d)
        whole = np.flatnonzero(words.size[first[node]] == d)
        if len(whole):
            if prefixes:
                hit = whole
            else:
                k = batch.size[q[whole]] - d + 1
                cell = np.choose(np.clip(k, 0, 2), [r[whole] for r in row])
                hit = whole[(k >= 0) & (k <= 2) & (cell == 1)]
            found.append((q[hit], first[node[hit]]))
        if not prefixes and d >= 12 and (end[node] - first[node]).sum() <= few:
            longer = [(a, i) for a, s, e in zip(q.tolist(), first[node].tolist(), end[node].tolist()) for i in range(s, e) if words.size[i] > d and one_edit(batch.words[a], words.words[i])]
            found.append(tuple(np.array(longer, np.int64).reshape(-1, 2).T))
            break
        below, _ = words.level(d + 1)
        if not len(below):
            break
        lo, hi = np.searchsorted(below, first)[node], np.searchsorted(below, end)[node]
        near, child = np.repeat(np.arange(len(q)), hi - lo), slices(lo, hi - lo)
        c, at = words.flat[words.start[below[child]] + d], batch.start[q[near]] + d
        b0, b1, b2 = (r[near] for r in row)
        n0 = np.minimum(b0 + (c != batch.flat[at - 1]), b1 + np.uint8(1))
        n1 = np.minimum(np.minimum(b1 + (c != batch.flat[at]), b2 + np.uint8(1)), n0 + np.uint8(1))
        n2 = np.minimum(b2 + (c != batch.flat[at + 1]), n1 + np.uint8(1))
        left = batch.size[q[near]] - d  # letters of the batch's word beyond d
        n0[left < 0], n1[left < 1], n2[left < 2] = FAR, FAR, FAR
        live = np.flatnonzero(np.minimum(np.minimum(n0, n1), n2) <= 1)
        q, node, row, d = q[near[live]], child[live], (n0[live], n1[live], n2[live]), d + 1
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (tuple(zip(*found)) or ((), ())))


def _latin(col: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in col.to_pylist()]


def near_pairs(vocabulary: DataFrame, shard: int = SHARD, batch: int = BATCH) -> DataFrame:
    """(word, near, near_n) of all words one edit apart. vocabulary: distinct words of A-Z, a-z, U+00C0 to U+00FF and their n."""
    spark = vocabulary.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = staged(vocabulary.select("word", "n").repartitionByRange(parts, "word").sortWithinPartitions("word"), "op12-words")

    def cut(batches):
        """Shards of neighbouring words in sorted order."""
        held: list[bytes] = []
        counts: list[int] = []

        def out(k):
            nonlocal held, counts
            mine, held, own, counts = held[:k], held[k:], counts[:k], counts[k:]
            return pd.DataFrame({"prefixes": [sorted({w[:PREFIX].decode("latin-1") for w in mine})], "list": [pickle.dumps((mine, np.array(own)), 5)]})

        for pdf in batches:
            held += [w.encode("latin-1") for w in pdf["word"]]
            counts += pdf["n"].tolist()
            while len(held) >= shard:
                yield out(shard)
        if held:
            yield out(len(held))

    # the sorted partitions are sorted once more as they are read: files may be split or put together
    ordered = words.repartitionByRange(parts, "word").sortWithinPartitions("word")
    lists = staged(ordered.mapInPandas(cut, "prefixes array<string>, list binary").withColumn("shard", F.monotonically_increasing_id()), "op12-lists")
    places = lists.select("shard", F.explode("prefixes").alias("p")).collect()  # at most 90 to the third, and one more a shard
    upper = WordList(sorted({r["p"].encode("latin-1") for r in places}))
    number = {p: i for i, p in enumerate(upper.words)}
    by_prefix: list[list[int]] = [[] for _ in upper.words]
    for r in places:
        by_prefix[number[r["p"].encode("latin-1")]].append(r["shard"])

    def send(batches):
        """Each batch's words to the shards that may hold near words."""
        for b in batches:
            all_words = _latin(column(b, "word"))
            for i in range(0, len(all_words), batch):
                mine = all_words[i : i + batch]
                to: dict[int, set[int]] = {}
                for a, p in zip(*(x.tolist() for x in scan(upper, Batch(mine), prefixes=True))):
                    for s in by_prefix[p]:
                        to.setdefault(s, set()).add(a)
                if to:
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array([b"\n".join(mine[a] for a in sorted(own)) for own in to.values()], pa.binary())], names=["shard", "asked"])

    def search(batches):
        held, which = None, None
        for b in batches:
            for s, blob, asked in zip(*(column(b, x) for x in ("shard", "list", "asked"))):
                if which != s.as_py():
                    which, (own, n) = s.as_py(), pickle.loads(blob.as_py())
                    held = WordList(own)
                mine = asked.as_py().split(b"\n")
                for i in range(0, len(mine), batch):
                    some = mine[i : i + batch]
                    a, k = scan(held, Batch(some))
                    yield pa.RecordBatch.from_arrays([pa.array([some[x].decode("latin-1") for x in a.tolist()], pa.string()), pa.array([held.words[x].decode("latin-1") for x in k.tolist()], pa.string()), pa.array(n[k], pa.int64())], names=["word", "near", "near_n"])

    sent = words.select("word").mapInArrow(send, "shard long, asked binary")
    pairs = sent.join(lists.select("shard", "list"), "shard").select("shard", "list", "asked").mapInArrow(search, "word string, near string, near_n long")
    pairs._made_of = words, lists
    return pairs


def with_roots(forms: DataFrame) -> DataFrame:
    """word and form (null: none) -> word, root. Each round doubles the steps that a word has taken towards its root."""
    at = staged(forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNotNull().alias("moved")), "op12-roots")
    while not at.filter("moved").isEmpty():
        on = at.filter("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        before, at = at, staged(step, "op12-roots")
        discard(before)
    return at.select("word", "root")


def variants(docs: DataFrame, least_length: int = 5, least: int = 3, times: int = 2, modulus: int = 97) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word of at least `least_length` letters and `least` occurrences."""
    words = staged(count_words(docs, least_length, modulus).filter(F.col("n") >= least), "op12-vocabulary")
    pairs = near_pairs(words)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("b"))
    rows = words.join(best, "word", "left")
    form = F.when(-F.col("b.less") >= times * F.col("n"), F.struct(F.col("b.near").alias("form"), (-F.col("b.less")).alias("form_n")))
    forms = staged(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("f")).select("word", "n", "n_near", "f.*"), "op12-forms")
    discard(words, *pairs._made_of)
    return forms.join(with_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
