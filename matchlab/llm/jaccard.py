"""N-gram Jaccard self-join with a token-group matrix.

A document is its set of distinct 5-word shingles; two documents link when the sets' Jaccard similarity is 0.75 or
more. Equal sets are one class. For the rest:

1. Order tokens by (frequent, hash) and keep of each set of n tokens, which needs an overlap of o = ceil(0.75 n), the
   first n - o + 3: linked sets share 3 or more of these, and by both sizes only the places that _within allows count.
   Tokens of one set only drop out.
2. Leaders: every set is compared with the set of like size that holds one of its tokens earliest; links give groups.
3. Matrix: token x group, the union of the group members' kept tokens, with the members' sizes and the token's first
   place. A set's overlap with a group's union bounds its overlap with every member; only groups that reach the bound
   are opened, and only members of other groups compared.
4. Links of both rounds give the components.

Comparisons read whole texts and count exactly; sets are told apart by 128-bit hashes, shingles by 64-bit ones. The
frequent-token list only changes the order, never the result: it is bounded, built from counts over all documents.

Edge cases: null or empty texts have an empty set and link with nothing (their component is their own id); texts of
fewer than 5 words are one shingle; rows that repeat a doc_id share its component; a null doc_id gets the smallest id of
its class or, alone, null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, discard, keyed, mix, same_key, shingle_sets, staged, staged_all, text_chunks
from .graph import components

NUM, DEN = 75, 100
SHARED = 3  # tokens that the kept parts of linked sets share
FREQUENT = 50_000  # tokens ordered last, at most
SALTS = 64
LEVELS = 32  # by which a leader's tokens are early
SLICES = 2  # turns in which texts are moved, at most


def _need(n):
    """Least overlap of a set of n tokens with a linked one."""
    return -(-NUM * n // DEN)


def _signatures(tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.r_[0, np.cumsum(n)]
    out = []
    for seed in (np.uint64(0x1234567), np.uint64(0x9E3779B97F4A7C15)):
        s = np.r_[np.uint64(0), np.cumsum(mix(tokens ^ seed), dtype=np.uint64)]
        out.append(mix(s[ends[1:]] - s[ends[:-1]] + n.astype(np.uint64) * seed).view(np.int64))
    return out[0], out[1]


def sets_of(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, th, n, s1, s2) of every document, and the frequent tokens."""

    def run(batches):
        often: Counter = Counter()
        names = ["frequent", "doc_id", "th", "n", "s1", "s2"]
        for b, texts in text_chunks(batches):
            tokens, n = shingle_sets(texts)
            s1, s2 = _signatures(tokens, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), bool)), b.column(0), b.column(1), pa.array(n), pa.array(s1), pa.array(s2)], names=names)
            t, c = np.unique(tokens, return_counts=True)
            hot = c >= max(8, len(texts) // 250)
            often.update(dict(zip(t[hot].view(np.int64).tolist(), c[hot].tolist())))
            if len(often) > 40_000:
                often = Counter(dict(often.most_common(20_000)))
        rows = often.most_common(5_000)
        if rows:
            k = len(rows)
            yield pa.RecordBatch.from_arrays([pa.array([True] * k), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array([c for _, c in rows], pa.int64()), pa.array([t for t, _ in rows], pa.int64()), pa.nulls(k, pa.int64())], names=names)

    rows = staged(keyed(docs).mapInArrow(run, "frequent boolean, doc_id long, th long, n long, s1 long, s2 long"), "op7-sets")
    top = rows.filter("frequent").groupBy("s1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s1").limit(FREQUENT).select("s1").collect()
    return rows.filter("not frequent").drop("frequent"), np.sort(np.array([r["s1"] for r in top], np.int64).view(np.uint64))


def kept_tokens(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(token, s1, n, pos) for the kept tokens that at least two different sets hold; pos is the token's place in its set's order."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent)  # at most FREQUENT numbers

    def emit(batches):
        hot = shared.value
        for b, texts in text_chunks(batches):
            tokens, n = shingle_sets(texts)
            s1, _ = _signatures(tokens, n)
            first = np.cumsum(n) - n
            is_hot = np.zeros(len(tokens), bool)
            if len(hot) and len(tokens):
                at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
                is_hot = hot[at] == tokens
            doc = np.repeat(np.arange(len(n)), n)
            # place by (frequent, hash): tokens come by hash, so those of a kind keep their order
            cold = np.r_[0, np.cumsum(~is_hot)]
            before = cold[:-1] - cold[first][doc]
            rank = np.where(is_hot, cold[first + n][doc] - cold[first][doc] + np.arange(len(tokens)) - first[doc] - before, before)
            o = _need(n)
            keep = rank < np.minimum(n, n - o + np.minimum(SHARED, o))[doc]
            _, one = np.unique(s1, return_index=True)  # copies within the chunk
            single = np.zeros(len(n), bool)
            single[one] = True
            keep &= single[doc]
            t, d, h = tokens[keep], doc[keep], is_hot[keep]
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(s1[d]), pa.array(n[d].astype(np.int32)), pa.array(rank[keep].astype(np.int32)), pa.array(h)], names=["token", "s1", "n", "pos", "hot"])

    def recurring(batches):
        """Rows come sorted by token, s1; a token's last distinct row waits for the next one."""
        last = None  # token, s1, n, pos, hot, already given out
        names = ["token", "s1", "n", "pos"]
        for b in batches:
            t, s, n, at, h = (column(b, c).to_numpy(zero_copy_only=False) for c in ("token", "s1", "n", "pos", "hot"))
            if not len(t):
                continue
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
            if last:
                fresh[0] = (t[0], s[0]) != last[:2]
            t, s, n, at, h = t[fresh], s[fresh], n[fresh], at[fresh], h[fresh]
            if not len(t):
                continue
            out = h.astype(bool)
            same = t[1:] == t[:-1]
            out[1:] |= same
            out[:-1] |= same
            if last:
                meets = t[0] == last[0]
                out[0] |= meets
                if (meets or last[4]) and not last[5]:
                    yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]]), pa.array([last[2]], pa.int32()), pa.array([last[3]], pa.int32())], names=names)
            done = bool(out[-1])
            yield pa.RecordBatch.from_arrays([pa.array(t[out]), pa.array(s[out]), pa.array(n[out].astype(np.int32)), pa.array(at[out].astype(np.int32))], names=names)
            last = (int(t[-1]), int(s[-1]), int(n[-1]), int(at[-1]), bool(h[-1]), done)

    rows = keyed(docs).select("text").mapInArrow(emit, "token long, s1 long, n int, pos int, hot boolean")
    salt = F.when(F.col("hot"), F.pmod("s1", F.lit(SALTS))).otherwise(0)  # a frequent token's rows are kept anyway, so they may part
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token", salt).sortWithinPartitions("token", "s1")
    return rows.mapInArrow(recurring, "token long, s1 long, n int, pos int")


def _within(pos: str, n: str, other):
    """Is a token at `pos` of n among those of which linked sets of n and `other` tokens share SHARED? Of an overlap of o,
    the k-th shared token has o - k others after it in both sets."""
    o = F.ceil((F.col(n) + other) * NUM / (NUM + DEN))
    return F.col(pos) < F.col(n) - o + F.least(F.lit(SHARED), o)


def _sizes(q: str, d: str):
    return F.least(q, d) * DEN >= F.greatest(q, d) * NUM


def _slices(spark) -> int:
    """In how many turns texts are moved: a turn's shuffle files go before the next one's come. Any number gives the same rows."""
    return max(1, min(SLICES, int(spark.conf.get("spark.sql.shuffle.partitions")) // 12))


def _turn(n: int, i: int, *keys: str):
    return F.pmod(F.xxhash64(*keys), F.lit(n)) == i


def texts_of(docs: DataFrame, first: DataFrame) -> DataFrame:
    """(s1, text, turn) of the documents (doc_id, th) that stand for the sets s1 of `first`, stored by turn of s1."""
    n, text = _slices(docs.sparkSession), keyed(docs)
    parts = ((text.filter(_turn(n, i, "doc_id", "th")), first.filter(_turn(n, i, "doc_id", "th"))) for i in range(n))
    met = (t.join(f, same_key(t, f)).select("s1", "text", F.pmod(F.xxhash64("s1"), F.lit(n)).cast("int").alias("turn")) for t, f in parts)
    return staged_all(met, "op7-texts", "turn")


def verify(pairs: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """The pairs (q, d) of sets that link, by exact counts over both texts."""

    def run(batches):
        for b, tq in text_chunks(batches, limit=2_000_000, column="tq"):
            td = column(b, "td").cast(pa.binary()).to_pylist()
            number: dict[bytes, int] = {}
            at = [(number.setdefault(x, len(number)), number.setdefault(y, len(number))) for x, y in zip(tq, td)]
            tokens, n = shingle_sets(list(number))
            ends = np.cumsum(n)
            sets = [tokens[e - k : e] for e, k in zip(ends, n)]
            link = np.empty(len(at), bool)
            for i, (x, y) in enumerate(at):
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                link[i] = DEN * both >= NUM * (len(sets[x]) + len(sets[y]) - both) and both > 0
            yield pa.RecordBatch.from_arrays([column(b, "q"), column(b, "d")], names=["q", "d"]).filter(pa.array(link))

    n = _slices(pairs.sparkSession)
    own = lambda i, a, b: texts.filter(F.col("turn") == i).select(F.col("s1").alias(a), F.col("text").alias(b))
    half = staged_all((pairs.select("q", "d").filter(_turn(n, i, "d")).join(own(i, "d", "td"), "d").select("q", "d", "td") for i in range(n)), "op7-half")
    met = (half.filter(_turn(n, i, "q")).join(own(i, "q", "tq"), "q").select("q", "d", "tq", "td") for i in range(n))
    out = staged_all((x.mapInArrow(run, "q long, d long") for x in met), label)
    discard(half)
    return out


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) of every document."""
    return grouped(docs).drop("group")


def grouped(docs: DataFrame) -> DataFrame:
    """As join, with the component's own number as group (null for an empty set): components of which rows repeat a
    doc_id may share a component_id."""
    sets, frequent = sets_of(docs)
    tokens = staged(kept_tokens(docs, frequent), "op7-tokens")
    # a set with too few recurring tokens links with no other
    known = tokens.groupBy("s1", "n").agg(F.count("*").alias("c")).filter(F.col("c") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * NUM / DEN))).select("s1")
    rows = known_rows = staged(tokens.join(known, "s1", "left_semi").select("s1", "token", "n", "pos"), "op7-known")
    discard(tokens)
    # leaders: of the sets of like size on a token, the one that has it earliest, so with the fewest rarer tokens; the
    # two series of size classes overlap by halves
    near = rows.filter(_within("pos", "n", F.col("n"))).withColumn("size", F.log("n") / float(np.log(DEN / NUM)))
    near = near.select("token", "s1", "n", "pos", F.explode(F.array(2 * F.floor("size"), 2 * F.floor(F.col("size") + 0.5) + 1)).alias("size"))
    early = F.floor(F.col("pos") * LEVELS / F.col("n"))
    lead = near.groupBy("token", "size").agg(F.min(F.struct(early.alias("e"), F.col("s1").alias("d"), F.col("n").alias("nd"))).alias("x")).select("token", "size", "x.d", "x.nd")
    pairs = near.withColumnsRenamed({"s1": "q", "n": "nq"}).join(lead, ["token", "size"]).filter((F.col("q") != F.col("d")) & _sizes("nq", "nd"))
    # a leader's count misses the shared tokens that have another leader, so the full bound waits for the second round
    pairs = pairs.groupBy(F.least("q", "d").alias("q"), F.greatest("q", "d").alias("d")).agg(F.count_distinct("token").alias("c"), F.min(F.least("nq", "nd")).alias("n"))
    pairs = staged(pairs.filter(F.col("c") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * NUM / DEN))).select("q", "d"), "op7-pairs")
    first = sets.filter("n > 0").groupBy("s1").agg(F.min(F.struct("doc_id", "th")).alias("r")).join(rows.select("s1").distinct(), "s1", "left_semi").select("s1", "r.*")
    first = staged(first, "op7-first")  # read in every turn
    texts = texts_of(docs, first)
    links = verify(pairs, texts, "op7-links").select(F.col("q").alias("u"), F.col("d").alias("v"))
    group = components(links, "op7-groups")
    # matrix and bounds
    rows = rows.join(group.withColumnsRenamed({"node": "s1", "component": "g"}), "s1", "left").withColumn("g", F.coalesce("g", "s1"))
    mixed = rows.groupBy("token").agg(F.min("g").alias("a"), F.max("g").alias("b")).filter("a < b").select("token")
    rows = matrix_rows = staged(rows.join(mixed, "token", "left_semi"), "op7-matrix")
    discard(known_rows, first)
    q = rows.select("token", F.col("s1").alias("q"), F.col("n").alias("nq"), F.col("g").alias("gq"), F.col("pos").alias("pq"))
    matrix = rows.groupBy("token", F.col("g").alias("gd")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("first"), F.max("s1").alias("top"))
    # a member's chance to hold the token early enough is best at the group's ends of size that still fit the query; the
    # smaller set of a pair opens the group of the other
    lo, hi = F.greatest(F.col("low"), F.ceil(F.col("nq") * NUM / DEN)), F.least(F.col("high"), F.floor(F.col("nq") * DEN / NUM))
    o = F.ceil((F.col("nq") + hi) * NUM / (NUM + DEN))
    fits = (F.col("gq") != F.col("gd")) & (F.col("q") < F.col("top")) & (lo <= hi) & _within("pq", "nq", lo) & (F.col("first") <= hi - o + SHARED)
    # only tokens that fit can count for a member, so an opened group is asked for these alone
    opened = q.join(matrix, "token").filter(fits).groupBy("q", "nq", "gd").agg(F.collect_list(F.struct("token", "pq")).alias("on"))
    opened = opened.filter(F.size("on") >= F.least(F.lit(SHARED), F.ceil(F.col("nq") * NUM / DEN)))
    opened = staged(opened.select("q", "nq", "gd", F.inline("on")), "op7-opened")
    d = rows.select("token", F.col("s1").alias("d"), F.col("n").alias("nd"), F.col("g").alias("gd"), F.col("pos").alias("pd"))
    both = (F.col("q") < F.col("d")) & _sizes("nq", "nd") & _within("pq", "nq", F.col("nd")) & _within("pd", "nd", F.col("nq"))
    cross = opened.join(d, ["token", "gd"]).filter(both)
    cross = cross.groupBy("q", "d", "nq", "nd").agg(F.count("*").alias("c")).filter(F.col("c") >= F.least(F.lit(SHARED), F.ceil((F.col("nq") + F.col("nd")) * NUM / (NUM + DEN)))).select("q", "d")
    cross = staged(cross.join(pairs, ["q", "d"], "left_anti"), "op7-cross")
    discard(matrix_rows, opened, pairs)
    more = verify(cross, texts, "op7-more").select(F.col("q").alias("u"), F.col("d").alias("v"))
    every = links.unionByName(more)
    final = components(every, "op7-components").withColumnsRenamed({"node": "s1", "component": "g"})
    discard(texts, cross)
    classes = sets.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("first")).join(final, "s1", "left").withColumn("g", F.coalesce("g", "s1"))
    smallest = classes.groupBy("g").agg(F.min("first").alias("component_id"))
    named = classes.join(smallest, "g").select("s1", "s2", "component_id", F.col("g").alias("group"))
    out = sets.join(named, ["s1", "s2"], "left")
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.when(F.col("n") > 0, F.col("group")).alias("group"))
