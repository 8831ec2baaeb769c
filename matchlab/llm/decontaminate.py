"""Benchmark decontamination with a BM25 index of the test items and block-max WAND.

Index: postings of every item word with impacts, cut into blocks with their largest impact. An impact is the word's BM25
part divided by the item's score against itself, so one threshold serves all items. Query: overlapping passages cover
every text. Items stand in classes by their number of words, each class twice as long as the one before; its passages
have twice the words of its longest possible item and move by half of that, so one passage holds an item whole. A passage whose distinct words' largest impacts sum below the threshold can hold no item, all others run block-max WAND and
retrieve every item at or above it. Verification: the item's question and answer are each compared
by the share of their 3-word shingles that the passage and its surroundings hold.

Items are dealt to blocks of about `block_items` items or `block_bytes` of text. A task builds each block's index and
writes it to the shared folder; one scan of the documents holds every passage against one block after another, so a
worker has one block in memory and the driver none. Numbers of items and words and the items that hold each word are
counted over all items, so the blocks change no result.

Edge cases: null or empty texts hold nothing and match nothing; an item without words is left out; items with fewer
than 3 words compare whole; repeated rows of a document or item are reported once per (doc_id, item_id); a null id is
reported as null; an empty benchmark or document table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, keyed, scratch, staged, text_chunks

_STRIP = b".,;:!?\"'()[]"
K1, B = 1.2, 0.75


def words(text: bytes) -> list[bytes]:
    return [x for x in (w.strip(_STRIP) for w in text.lower().split()) if x]


def question_answer(text: str) -> tuple[str, str]:
    """At "Answer:" or after the last question mark; else the last quarter of the words is the answer."""
    m = re.search(r"(?i)\banswer\s*:", text)
    at = m.start() if m else text.rfind("?") + 1
    if 0 < at < len(text.rstrip()):
        return text[:at], text[at:]
    w = text.split()
    k = max(1, len(w) // 4) if len(w) > 1 else 0
    return " ".join(w[: len(w) - k]), " ".join(w[len(w) - k :])


def shingles(w: list[bytes], size: int = 3) -> set:
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def statistics(texts) -> tuple[int, float, dict]:
    tokens = [w for w in (words(t.encode()) for t in texts) if w]
    return len(tokens), sum(map(len, tokens)) / max(1, len(tokens)), Counter(x for w in tokens for x in set(w))


def length_classes(items: list[tuple[int | None, str]], size: int) -> list[tuple[int, list]]:
    """(words of a passage, items): those of at most half a passage's words, passages of `size` words or a power of two times that."""
    out: dict[int, list] = {}
    for item in items:
        n, k = len(item[1].encode().split()), size
        while 2 * n > k:
            k *= 2
        out.setdefault(k, []).append(item)
    return sorted(out.items())


class Index:
    """Postings by word: item numbers, impacts, and blocks' last item and largest impact."""

    def __init__(self, items: list[tuple[int | None, str]], block: int = 16, stats: tuple[int, float, dict] | None = None):
        """stats: number of items, mean words of one, items that hold each word, of all items; these alone if not given."""
        tokens = [words(t.encode()) for _, t in items]
        kept = [i for i, w in enumerate(tokens) if w]
        self.ids = [items[i][0] for i in kept]
        tokens = [tokens[i] for i in kept]
        n, mean, df = stats or statistics(t for _, t in items)
        post: dict[bytes, list[tuple[int, float]]] = {}
        for i, w in enumerate(tokens):
            tf = Counter(w)
            part = {x: math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / mean)) for x, c in tf.items()}
            own = sum(part.values())
            for x, v in part.items():
                post.setdefault(x, []).append((i, v / own))
        self.term = {x: k for k, x in enumerate(post)}
        self.items = [np.array([i for i, _ in p]) for p in post.values()]
        self.impacts = [np.array([v for _, v in p]) for p in post.values()]
        cuts = [range(0, len(p), block) for p in self.items]
        self.last = [[int(p[min(len(p), c + block) - 1]) for c in cs] for p, cs in zip(self.items, cuts)]
        self.block_max = [[float(v[c : c + block].max()) for c in cs] for v, cs in zip(self.impacts, cuts)]
        self.lists = [i.tolist() for i in self.items]
        self.block = block
        # largest impact of each word (a last row: none) within runs of neighbouring items
        own = len(tokens)
        self.run = max(4, -(-own // 64))
        self.bounds = np.zeros((max(1, -(-own // self.run)), len(post) + 1), np.float32)
        for t, (i, v) in enumerate(zip(self.items, self.impacts)):
            np.maximum.at(self.bounds[:, t], i // self.run, v.astype(np.float32))
        qa = [question_answer(items[i][1]) for i in kept]
        self.parts = [tuple(shingles(words(x.encode())) for x in p) for p in qa]
        self.longest = max((len(items[i][1].encode().split()) for i in kept), default=0)

    def retrieve(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Every item whose impacts over the distinct `terms` sum to at least the threshold: WAND in each run of items
        that the terms' largest impacts let reach it."""
        bound, out = self.bounds[:, terms], []
        for r in np.flatnonzero(bound.sum(1) >= threshold - 1e-6):
            out += self.wand(terms[bound[r] > 0].tolist(), threshold, int(r))
        return out

    def wand(self, terms: list[int], threshold: float, run: int) -> list[tuple[int, float]]:
        """Block-max WAND over the items of one run."""
        lo, hi = run * self.run, (run + 1) * self.run
        lists = [[bisect_left(self.lists[t], lo), t, self.lists[t][: bisect_left(self.lists[t], hi)], float(self.bounds[run, t])] for t in terms]  # position, term, items, bound
        out, slack = [], threshold - 1e-6
        while True:
            lists = [x for x in lists if x[0] < len(x[2])]
            lists.sort(key=lambda x: x[2][x[0]])
            bound, pivot = 0.0, None
            for k, x in enumerate(lists):
                bound += x[3]
                if bound >= slack:
                    pivot = k
                    break
            if pivot is None:
                return out
            item = lists[pivot][2][lists[pivot][0]]
            while pivot + 1 < len(lists) and lists[pivot + 1][2][lists[pivot + 1][0]] == item:
                pivot += 1
            shallow, ahead = 0.0, lists[pivot + 1][2][lists[pivot + 1][0]] if pivot + 1 < len(lists) else 1 << 60
            for x in lists[: pivot + 1]:
                j = bisect_left(self.last[x[1]], item)
                if j < len(self.last[x[1]]):
                    shallow += self.block_max[x[1]][j]
                    ahead = min(ahead, self.last[x[1]][j] + 1)
            if shallow < slack:  # no item before the nearest block end can reach the threshold
                target = max(ahead, item + 1)
                for x in lists[: pivot + 1]:
                    x[0] = bisect_left(x[2], target, x[0])
            elif lists[0][2][lists[0][0]] == item:
                score = 0.0
                for x in lists[: pivot + 1]:
                    score += float(self.impacts[x[1]][x[0]])
                    x[0] += 1
                if score >= slack:
                    out.append((item, score))
            else:
                for x in lists[:pivot]:
                    x[0] = bisect_left(x[2], item, x[0])


def _hits(indexes: list[tuple[int, Index]], texts: list[bytes], threshold: float, overlap: float):
    """(text number, item id, score, question overlap, answer overlap), the best passage of each pair; indexes: words of
    a passage and the items to find in such."""
    raw: list[bytes] = []
    counts = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.lower().split()
        counts[i] = len(w)
        raw += w
    if not raw:
        return
    arr = np.empty(len(raw), object)
    arr[:] = raw
    codes, uniq = pd.factorize(arr)
    for size, index in indexes:
        if index.ids:
            yield from _class_hits(index, raw, counts, codes, uniq, threshold, overlap, size, max(1, size // 2))


def _class_hits(index: Index, raw: list[bytes], counts: np.ndarray, codes: np.ndarray, uniq: np.ndarray, threshold: float, overlap: float, size: int, step: int):
    ids = np.fromiter((index.term.get(x.strip(_STRIP), -1) for x in uniq), np.int64, len(uniq))[codes]
    first = np.cumsum(counts) - counts
    k = np.maximum(1, -(-(counts - size) // step) + 1) * (counts > 0)
    doc_of = np.repeat(np.arange(len(counts)), k)
    lo = first[doc_of] + step * (np.arange(len(doc_of)) - np.repeat(np.cumsum(k) - k, k))
    hi = np.minimum(lo + size, (first + counts)[doc_of])
    open_ = np.zeros(len(lo), bool)  # passages that may hold an item of some run
    for bound in index.bounds:
        run = np.r_[0.0, np.cumsum(bound[ids], dtype=np.float64)]
        open_ |= run[hi] - run[lo] >= threshold - 1e-6
    maybe = np.flatnonzero(open_)
    best: dict[tuple[int, int], tuple] = {}
    for j in maybe:
        terms = np.unique(ids[lo[j] : hi[j]])
        terms = terms[terms >= 0]
        d = int(doc_of[j])
        found = index.retrieve(terms, threshold)
        if not found:
            continue
        a, e = max(int(first[d]), int(lo[j]) - index.longest), min(int(first[d] + counts[d]), int(hi[j]) + index.longest)
        own = [x for x in (w.strip(_STRIP) for w in raw[a:e]) if x]
        near = shingles(own) | {tuple(own[i : i + n]) for n in (1, 2) for i in range(len(own) - n + 1)}
        for item, score in found:
            q, r = (len(p & near) / len(p) if p else 1.0 for p in index.parts[item])
            if q >= overlap and r >= overlap:
                best[d, item] = max(best.get((d, item), (0.0, 0.0, 0.0)), (score, q, r))
    for (d, item), v in best.items():
        yield d, index.ids[item], *v


def _counted(items: DataFrame) -> DataFrame:
    """(block, word, c, n): in each block of items, the items that hold each word; c items of n words at the null word."""

    def run(batches):
        for b, texts in text_chunks(batches):
            of, found, items, total = column(b, "block").to_pylist(), Counter(), Counter(), Counter()
            for k, t in zip(of, texts):
                w = words(t)
                if w:
                    found.update((k, x) for x in set(w))
                    items[k] += 1
                    total[k] += len(w)
            rows = [(k, x, c, 0) for (k, x), c in found.items()] + [(k, None, c, total[k]) for k, c in items.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=["block", "word", "c", "n"])

    rows = items.select("block", "text").mapInArrow(run, "block long, word binary, c long, n long")
    return staged(rows.groupBy("block", "word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "op9-counts")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.5, size: int = 128, block_items: int = 20_000, block_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, th, item_id, score, question_overlap, answer_overlap: every verified pair; size: words of a passage for
    the shortest class of items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna(subset=["text"]).distinct()
    spark, schema = docs.sparkSession, "doc_id long, th long, item_id long, score double, question_overlap double, answer_overlap double"
    names = [x.split()[0] for x in schema.split(", ")]
    size_of = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    blocks = max(1, -(-size_of["n"] // block_items), -(-size_of["b"] // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    counted = _counted(items)
    total = counted.filter("word is null").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    held = counted.filter("word is not null").groupBy("word").agg(F.sum("c").alias("df"))
    known = counted.filter("word is not null").select("block", "word").join(held, "word")
    path = scratch(spark, "op9-index")

    def build(mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(((None if i is None else int(i), t) for i, t in zip(mine["item_id"], mine["text"])), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        stats = (total["c"], total["n"] / max(1, total["c"]), {bytes(w): int(c) for w, c in zip(known["word"], known["df"])})
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        name = f"{base}/{uuid.uuid4().hex}"
        with fs.open_output_stream(name) as out:
            out.write(pickle.dumps([(n, Index(x, stats=stats)) for n, x in length_classes(rows, size)], protocol=5))
        return pd.DataFrame({"file": [name] * min(1, len(mine))})

    text_ids = items.withColumn("item_id", F.col("item_id").cast("string"))  # pandas has no whole numbers beside nulls
    made = staged(text_ids.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(build, "file string"), "op9-files")
    files = [r["file"] for r in made.orderBy("file").collect()]  # one for each block

    def run(batches):
        fs, _ = pafs.FileSystem.from_uri(path)
        last: list = [None, None]
        for b, texts in text_chunks(batches):
            doc, th = column(b, "doc_id").to_pylist(), column(b, "th").to_pylist()
            for f in files:
                if f != last[0]:
                    last[:] = f, None  # one index at a time
                    with fs.open_input_stream(f) as src:
                        last[1] = pickle.loads(src.read())
                rows = [(doc[d], th[d], i, s, q, r) for d, i, s, q, r in _hits(last[1], texts, threshold, overlap)]
                if rows:
                    kinds = [pa.int64()] * 3 + [pa.float64()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    out = keyed(docs).mapInArrow(run, schema)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    return out.groupBy("doc_id", "th", "item_id").agg(best).select("doc_id", "th", "item_id", "best.*")
