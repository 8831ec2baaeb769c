"""Best-fit packing by the linear grouping scheme.

Documents become token ids plus an end id; only longer ones than a sequence are cut. Pieces are counted by length (at
most `capacity` numbers reach the driver, whatever the corpus). Pieces longer than `small` are large: in order of length
they are dealt into groups of equal number, and each length is rounded up to the largest of its group, so that few sizes
remain; a linear program over the configurations of these sizes (columns priced by a knapsack) tells how often each
configuration is used. The pieces of a group, longest first, then take the places of its size, which leaves the room
that rounding up had kept free; what the rounded program leaves over and all small pieces, longest first, go to the
sequence that has the least room for them. Sequences with equal contents are planned as one run with a count, so the plan
is a few thousand lines for any corpus. Each piece's rank among those of its length gives its sequence and place.

Edge cases: a null text is empty and packs as the end id alone; rows that repeat an id are packed each; texts of any
length are cut into full pieces and one rest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import column, discard, keyed, staged, text_chunks
from .packing import column_generation
from .tokens import crc, word_encoder

#: Sizes that the large pieces are rounded to; tokens that the linear program counts as one.
GROUPS = 32
UNIT = 8
#: Bytes of text encoded at once: words that a chunk repeats are looked up once.
CHUNK_BYTES = 8_000_000
#: Parts of a sequence up to which pieces may count as small.
SMALL = (8, 3, 2)


class Runs:
    """Sequences planned so far: by room left, runs of (number of sequences, ((length, pieces), ...))."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]

    def add(self, number: int, content: tuple) -> None:
        if number > 0:
            self.by_room[self.capacity - sum(n * k for n, k in content)].append((number, content))

    def best_fit(self, length: int, count: int) -> None:
        """Put `count` pieces of one length, each where the room left is least."""
        room = length
        while count > 0:
            while room <= self.capacity and not self.by_room[room]:
                room += 1
            if room > self.capacity:  # new sequences
                self.by_room[self.capacity].append((-(-count // (self.capacity // length)), ()))
                room = self.capacity
            number, content = self.by_room[room].pop()
            each = room // length
            full = min(number, count // each)
            self.add(full, (*content, (length, each)))
            count -= full * each
            if full < number and count < each:
                if count:
                    self.add(1, (*content, (length, count)))
                self.add(number - full - (count > 0), content)
                count = 0

    def total(self) -> int:
        return sum(number for number, _ in self)

    def __iter__(self):
        return (run for runs in self.by_room for run in runs)


def grouped_sizes(lengths: np.ndarray, counts: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, first ranks, end ranks) of groups of equal number. lengths fall; a rank counts pieces, longest first."""
    total = int(counts.sum())
    each = -(-total // groups)
    first = np.arange(0, total, each)
    return lengths[np.searchsorted(np.cumsum(counts), first, side="right")], first, np.minimum(first + each, total)


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS, unit: int = UNIT) -> Runs:
    """The fewest runs over the bounds between small and large pieces: where small ones are scarce, rounding large ones of
    all lengths leaves room that nothing fills, so only the largest are then rounded."""
    return min((plan_beyond(capacity // k, histogram, capacity, groups, unit) for k in SMALL), key=lambda runs: runs.total())


def plan_beyond(small: int, histogram: dict[int, int], capacity: int, groups: int = GROUPS, unit: int = UNIT) -> Runs:
    """Runs that hold every piece of the histogram {length: number} exactly once; pieces longer than `small` are large."""
    runs, left = Runs(capacity), dict(histogram)
    runs.add(left.pop(capacity, 0), ((capacity, 1),))
    lengths = np.array(sorted((x for x in left if x > small), reverse=True), np.int64)
    if len(lengths):
        counts = np.array([left[x] for x in lengths.tolist()], np.int64)
        ends = np.cumsum(counts)
        sizes, first, last = grouped_sizes(lengths, counts, groups)
        widths, own = np.unique(-(-sizes // unit), return_inverse=True)  # groups of one rounded size count together
        demand = np.bincount(own, (last - first).astype(float)).astype(np.int64)
        # groups of one size are neighbours: their ranks are one range
        start = np.array([first[own == k].min() for k in range(len(widths))])
        stop = start + demand
        patterns, times = column_generation(widths, demand, capacity // unit)
        for pattern, t in zip(patterns, np.floor(times + 1e-6).astype(np.int64)):
            used = np.flatnonzero(pattern)
            t = int(min(t, min(((stop[g] - start[g]) // pattern[g] for g in used), default=0)))
            if t <= 0:
                continue
            slots = [(start[g] + k, pattern[g]) for g in used for k in range(pattern[g])]  # rank in the first sequence, and step
            # a sequence's contents change where the rank of a slot passes the end of a length
            turns = np.unique(np.concatenate([[0, t], *(-(-(ends - r) // step) for r, step in slots)]))
            turns = turns[(turns >= 0) & (turns <= t)]
            for a, b in zip(turns[:-1].tolist(), turns[1:].tolist()):
                held: dict[int, int] = {}
                for r, step in slots:
                    x = int(lengths[np.searchsorted(ends, r + a * step, side="right")])
                    held[x] = held.get(x, 0) + 1
                runs.add(b - a, tuple(held.items()))
                for x, k in held.items():
                    left[x] -= k * (b - a)
            for g in used:
                start[g] += t * pattern[g]
    for x in sorted(left, reverse=True):
        runs.best_fit(x, left[x])
    return runs


def places(runs: Runs) -> dict[int, tuple[np.ndarray, ...]]:
    """{length: (first ranks, first sequence, pieces in a sequence, offset of the first)} of the runs' sequences, numbered on."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    seq = 0
    for number, content in runs:
        at = 0
        for x, k in content:
            out.setdefault(x, []).append((taken.get(x, 0), seq, k, at))
            taken[x] = taken.get(x, 0) + k * number
            at += x * k
        seq += number
    return {x: tuple(np.array(c, np.int64) for c in zip(*v)) for x, v in out.items()}


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, ids: bool = False) -> DataFrame:
    """(doc_id, th, piece, start, length, ids_crc32), with the ids themselves if asked for."""

    def cut(batches):
        enc = word_encoder(tokenizer)
        for b, texts in text_chunks(batches, CHUNK_BYTES):
            flat, lens = enc.encode(texts)
            ends, rows = np.cumsum(lens), []
            for doc, th, e, k in zip(column(b, "doc_id").to_pylist(), column(b, "th").to_pylist(), ends, lens):
                own = np.append(flat[e - k : e], np.uint32(end_id))
                rows += [(doc, th, s // capacity, s, min(capacity, len(own) - s), crc(part := own[s : s + capacity]), part) for s in range(0, len(own), capacity)]
            cols = list(zip(*rows))
            arrays = [pa.array(c, t) for c, t in zip(cols[:6], [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3])]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(cols[6], pa.list_(pa.int64()))] * ids, names=NAMES + ["ids"] * ids)

    return keyed(docs).mapInArrow(cut, SCHEMA + ", ids array<long>" * ids)


NAMES = ["doc_id", "th", "piece", "start", "length", "ids_crc32"]
SCHEMA = "doc_id long, th long, piece int, start long, length long, ids_crc32 long"


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, groups: int = GROUPS, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and its ids if asked for."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["length", "doc_id", "th", "start"]
    cut = staged(pieces(docs, tokenizer, end_id, capacity, ids), "op13-cut")  # else the range split's sampling would encode again
    ranked = staged(cut.repartitionByRange(n, *key).sortWithinPartitions(*key).withColumn("row", F.monotonically_increasing_id()), "op13-pieces")
    discard(cut)
    part = F.shiftright("row", 33)
    runs = ranked.groupBy("length", part.alias("part")).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    # The range split puts a length on neighbouring partitions: at most partitions + capacity rows.
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    histogram = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    table = places(plan(histogram, capacity, groups))
    names = NAMES + ["ids"] * ids

    def assign(batches):
        for b in batches:
            x, rank = column(b, "length").to_numpy(), column(b, "rank").to_numpy()
            seq, offset = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
            for k in np.unique(x):
                at = np.flatnonzero(x == k)
                first, sequence, each, base = table[int(k)]
                j = np.searchsorted(first, rank[at], side="right") - 1
                past = rank[at] - first[j]
                seq[at], offset[at] = sequence[j] + past // each[j], base[j] + past % each[j] * k
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in names), pa.array(seq), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    rows = ranked.withColumn("part", part).join(runs.drop("n"), ["length", "part"])
    rows = rows.withColumn("rank", F.col("row") - F.col("first") + F.col("base")).select(*names, "rank")
    return rows.mapInArrow(assign, SCHEMA + ", ids array<long>" * ids + ", sequence_id long, offset long").drop("th")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the token ids of every sequence, from pieces packed with their ids; a sequence holds at most `capacity` of them."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))
