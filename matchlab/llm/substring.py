"""Substring deduplication with an FM-index per shard.

A window is 50 consecutive words; a word is removed when a window over it also starts in a document of smaller doc_id.

1. Every window belongs to the smallest hash of its 8-word grams, so equal windows meet. Neighbouring windows of one
   smallest gram form a segment. Grams that occur in one document only drop out, equal segments become one with its
   smallest and largest doc_id: a passage of a third of the rows is one segment in each task before the shuffle.
2. Segments are dealt to shards by their gram. A shard indexes the segments of its earlier documents (Burrows-Wheeler
   transform in a wavelet matrix) and streams those of later ones against the index by backward search; where the
   matching statistic reaches 50 words, the suffix interval's smallest doc_id is reported. A gram of very many different segments is cut into single windows that are dealt by
   their own hash.
3. Reported intervals go back to the documents that hold the segment; covered words are removed.

Words are told apart by 64-bit hashes, documents' rows by (doc_id, hash of text).

Edge cases: a null or empty text has no words; a text of fewer than 50 words loses none; rows that repeat a doc_id are
judged each and never against each other; a null doc_id counts as larger than any other; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, hash_words, keyed, mix, rolling, same_key, slices, staged, text_chunks, word_codes
from .fmindex import FMIndex

WINDOW = 50
GRAM = 8
LAST = (1 << 63) - 1
SHARD_WORDS = 500_000
HOT_SEGMENTS = 50_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i+width] for every i that has it."""
    k, m = 1, x
    while 2 * k <= width:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return np.minimum(m[: len(x) - width + 1], m[width - k : width - k + len(x) - width + 1])


def segments(h: np.ndarray, counts: np.ndarray, window: int, gram: int):
    """(document number, start in it, windows, smallest gram, segment hash) over the texts' word hashes."""
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(h) < window:
        return none
    s, inv = rolling(h)
    g = mix((s[gram:] - s[:-gram]) * inv[: len(h) - gram + 1])
    low = _sliding_min(g, window - gram + 1)
    first = np.cumsum(counts) - counts
    n = np.maximum(counts - window + 1, 0)
    at, doc = slices(first, n), np.repeat(np.arange(len(counts)), n)
    if not len(at):
        return none
    low = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(at)])
    a = at[begin]
    seg = mix((s[a + size - 1 + window] - s[a]) * inv[a] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return doc[begin], a - first[doc[begin]], size, low[begin], seg


def shard_matches(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """rows: shard, gram, seg, off, doc (smallest doc_id), most (largest), words. Returns gram, seg, off, n, source: windows
    off..off+n-1 of the segment start in document `source`. The index holds the segments that a later document of their
    shard may repeat; streamed are those that some document comes before, so of two documents the earlier is indexed and
    the later streamed."""
    key = rows["shard"]
    indexed = (rows["doc"] < rows.groupby(key)["most"].transform("max")).to_numpy()
    streamed = (rows["most"] > rows.groupby(key)["doc"].transform("min")).to_numpy()
    words = [w.split(b" ") for w in rows["words"]]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.empty(int(lengths.sum()), object)
    flat[:] = [x for w in words for x in w]
    symbol = pd.factorize(flat)[0] + 1
    first = np.cumsum(lengths) - lengths
    who, where, source = [], [], []
    if indexed.any():
        at = slices(first[indexed], lengths[indexed])
        n = lengths[indexed]
        text = np.zeros(len(at) + len(n), np.int64)
        text[np.arange(len(at)) + np.repeat(np.arange(len(n)), n)] = symbol[at]
        index = FMIndex(text, np.repeat(rows["doc"].to_numpy()[indexed], n + 1), window, int(symbol.max()) + 1)
        number = np.flatnonzero(streamed)
        for act, pos, least in index.matching(symbol, first[streamed], lengths[streamed]):
            who.append(number[act])
            where.append(pos)
            source.append(least)
    who, where, source = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (who, where, source))
    use = source < rows["most"].to_numpy()[who]
    who, where, source = who[use], where[use], source[use]
    order = np.lexsort((where, who))
    who, where, source = who[order], where[order], source[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (source[1:] != source[:-1]) | (where[1:] != where[:-1] + 1)
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(who)])
    w = who[begin]
    return pd.DataFrame({"gram": rows["gram"].to_numpy()[w], "seg": rows["seg"].to_numpy()[w], "off": rows["off"].to_numpy()[w] + where[begin], "n": size, "source": source[begin]})


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT_SEGMENTS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, th, n_words, n_removed, kept_sha256, removed): removed lists the removed word ranges as start:end."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = keyed(docs)

    def cut(batches):
        names = ["gram", "seg", "doc", "doc_id", "th", "start", "n"]
        for b, texts in text_chunks(batches):
            codes, counts, uniq = word_codes(texts)
            d, start, n, low, seg = segments(hash_words(uniq)[codes] if len(codes) else np.empty(0, np.uint64), counts, window, gram)
            ids, th = column(b, "doc_id").take(pa.array(d)), column(b, "th").take(pa.array(d))
            yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(seg.view(np.int64)), ids.fill_null(LAST), ids, th, pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], names=names)

    found = staged(text.mapInArrow(cut, "gram long, seg long, doc long, doc_id long, th long, start int, n int"), "op1-segments")
    twice = found.groupBy("gram").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select("gram")
    cand = staged(found.join(twice, "gram", "left_semi"), "op1-candidates")
    distinct = cand.groupBy("gram", "seg").agg(F.min(F.struct("doc", "doc_id", "th", "start", "n")).alias("r"), F.max("doc").alias("most"))
    parts = distinct.groupBy("gram").agg(F.count("*").alias("c")).withColumn("parts", F.when(F.col("c") > hot, F.ceil(F.col("c") * gram / hot)).otherwise(0).cast("int")).filter("parts > 0").select("gram", "parts")
    reps = distinct.join(parts, "gram", "left").select("gram", "seg", "most", "r.*", F.coalesce("parts", F.lit(0)).alias("parts"))
    lists = reps.groupBy("doc_id", "th").agg(F.collect_list(F.struct("gram", "seg", "most", "start", "n", "parts")).alias("segs"))  # no more than a document has

    def fetch(batches):
        names = ["shard", "gram", "seg", "off", "doc", "most", "words"]
        for b, texts in text_chunks(batches, limit=1_000_000):
            out = []
            for doc, t, segs in zip(column(b, "doc_id").to_pylist(), texts, column(b, "segs").to_pylist()):
                w, doc = t.split(), LAST if doc is None else doc
                for s in segs:
                    a, n = s["start"], s["n"]
                    if not s["parts"]:
                        out.append((s["gram"], s["gram"], s["seg"], 0, doc, s["most"], b" ".join(w[a : a + n - 1 + window])))
                        continue
                    for i in range(n):
                        x = b" ".join(w[a + i : a + i + window])
                        k = int.from_bytes(hashlib.blake2b(x, digest_size=7).digest(), "little") % s["parts"]
                        out.append((s["gram"] ^ (k + 1) << 1, s["gram"], s["seg"], i, doc, s["most"], x))
            if out:
                kinds = [pa.int64()] * 3 + [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    rows = text.join(lists, same_key(text, lists)).select(text["doc_id"], text["text"], "segs")
    rows = rows.mapInArrow(fetch, "shard long, gram long, seg long, off int, doc long, most long, words binary")
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard")

    def match(batches):
        """Rows come sorted by shard key; whole keys are gathered to about shard_words words for one index."""
        held, size = [], 0

        def index(df):
            return pa.RecordBatch.from_pandas(shard_matches(df, window), schema=schema, preserve_index=False)

        schema = pa.schema([("gram", pa.int64()), ("seg", pa.int64()), ("off", pa.int32()), ("n", pa.int32()), ("source", pa.int64())])
        for b in batches:
            df = b.to_pandas()
            held.append(df)
            size += int(df["words"].str.len().sum()) // 6
            if size >= shard_words:
                df = pd.concat(held, ignore_index=True)
                last = df["shard"].to_numpy() == df["shard"].iloc[-1]
                done, rest = df[~last], df[last]
                if len(done):
                    yield from (index(x) for x in _split(done, shard_words))
                held, size = [rest], int(rest["words"].str.len().sum()) // 6
        if held:
            df = pd.concat(held, ignore_index=True)
            if len(df):
                yield from (index(x) for x in _split(df, shard_words))

    hits = rows.mapInArrow(match, "gram long, seg long, off int, n int, source long")
    # back to every document that holds the segment
    back = hits.withColumnRenamed("n", "k").join(cand.select("gram", "seg", "doc", "doc_id", "th", "start"), ["gram", "seg"]).filter("source < doc")
    marks = back.groupBy("doc_id", "th").agg(F.collect_set(F.struct((F.col("start") + F.col("off")).alias("a"), F.col("k").alias("k"))).alias("marks"))  # windows of one document

    def remove(batches):
        for b, texts in text_chunks(batches):
            total, gone, sha, ranges = [], [], [], []
            for t, m in zip(texts, column(b, "marks").to_pylist()):
                w = t.split()
                total.append(len(w))
                if m:
                    cover = np.zeros(len(w) + 1, np.int64)
                    for x in m:
                        cover[x["a"]] += 1
                        cover[min(len(w), x["a"] + x["k"] - 1 + window)] -= 1
                    cover = np.cumsum(cover[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, cover, False].astype(np.int8)))
                    ranges.append(",".join(f"{a}:{e}" for a, e in zip(edge[::2], edge[1::2])))
                    gone.append(int(cover.sum()))
                    w = [x for x, c in zip(w, cover.tolist()) if not c]
                else:
                    ranges.append("")
                    gone.append(0)
                sha.append(hashlib.sha256(b" ".join(w)).hexdigest())
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "th"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha), pa.array(ranges)], names=["doc_id", "th", "n_words", "n_removed", "kept_sha256", "removed"])

    out = text.join(marks, same_key(text, marks), "left").select(text["doc_id"], text["th"], text["text"], "marks")
    return out.mapInArrow(remove, "doc_id long, th long, n_words long, n_removed long, kept_sha256 string, removed string")


def _split(df: pd.DataFrame, shard_words: int):
    """Parts of whole shard keys with about shard_words words each; df is sorted by key."""
    size = np.cumsum(df["words"].str.len().to_numpy()) // 6 // shard_words
    key = df["shard"].to_numpy()
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    cuts = [int(b) for i, b in enumerate(begin) if i == 0 or size[b] != size[begin[i - 1]]]
    for a, e in zip(cuts, [*cuts[1:], len(df)]):
        yield df.iloc[a:e].reset_index(drop=True)
