"""Packing by cutting-stock column generation.

Documents become token ids plus an end id; a document longer than a sequence is cut into full sequences and one rest.
Rests are counted by length class (multiples of `unit`), and the linear program over packing patterns is solved by
column generation: the basis of patterns gives prices of the classes, a knapsack dynamic program finds the pattern
worth most at these prices, and it enters the basis until none is worth more than a sequence. Patterns are used as
often as the floor of their weight, what is left is packed best fit first, and pieces, ranked within their class, take
the patterns' places. Only the histogram (at most capacity/unit rows) and the patterns reach the driver.

Edge cases: a null text is empty and packs as the end id alone; rows that repeat a doc_id are packed each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import column, keyed, staged, text_chunks
from .tokens import crc, encoder


def knapsack(values: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern (any number of each class) that fits, by dynamic programming over the capacity."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(widths, kind="stable")
    w, v = widths[order], values[order]
    ends = np.searchsorted(w, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], took[c] = best[c - 1], -1
        if ends[c]:
            x = best[c - w[: ends[c]]] + v[: ends[c]]
            i = int(x.argmax())
            if x[i] > best[c] + 1e-12:
                best[c], took[c] = x[i], i
    a, c = np.zeros(len(widths), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            a[order[took[c]]] += 1
            c -= w[took[c]]
    return float(best[capacity]), a


def column_generation(widths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000, within: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as rows, weights) of the linear program's basis; sum of weight*pattern equals the demand."""
    m = len(widths)
    basis = np.diag((capacity // widths).astype(float))
    inv = np.diag(1.0 / np.diag(basis))
    x = inv @ demand
    for _ in range(rounds):
        price = inv.sum(axis=0)
        worth, a = knapsack(np.maximum(price, 0), widths, capacity)
        if worth <= 1 + within:  # the optimum is at least sum(x)/worth
            break
        a = np.where(price > 0, a, 0)
        y = inv @ a
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(y > 1e-9, x / y, np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        x = np.maximum(x - step * y, 0)
        x[out] = step
        basis[:, out] = a
        inv[out] /= y[out]
        for_rows = np.arange(m) != out
        inv[for_rows] -= np.outer(y[for_rows], inv[out])
    return basis.T.round().astype(np.int64), x


def plan(widths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) covering the demand exactly: the rounded basis, then best fit for what rounding leaves."""
    if not len(widths):
        return []
    patterns, x = column_generation(widths, demand, capacity)
    left, out = demand.astype(np.int64).copy(), []
    for a, t in zip(patterns, np.floor(x + 1e-6).astype(np.int64)):
        used = a > 0
        t = int(min(t, (left[used] // a[used]).min(initial=t)))
        if t > 0:
            out.append((a, t))
            left -= a * t
    room: list[list[np.ndarray]] = [[] for _ in range(capacity + 1)]
    for i in np.argsort(-widths, kind="stable"):
        for _ in range(int(left[i])):
            c = next((c for c in range(widths[i], capacity + 1) if room[c]), None)
            a = room[c].pop() if c is not None else np.zeros(len(widths), np.int64)
            a[i] += 1
            room[(capacity if c is None else c) - widths[i]].append(a)
    return out + [(a, 1) for r in room for a in r]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, th, start, length, ids_crc32, doc_tokens): full sequences and one rest for each document."""

    def cut(batches):
        enc = encoder(tokenizer)
        for b, texts in text_chunks(batches):
            ids, lens = enc.encode(texts)
            ends, rows = np.cumsum(lens), []
            for doc, th, e, k in zip(column(b, "doc_id").to_pylist(), column(b, "th").to_pylist(), ends, lens):
                own = np.append(ids[e - k : e], np.uint32(end_id))
                rows += [(doc, th, s, min(capacity, len(own) - s), crc(own[s : s + capacity]), len(own)) for s in range(0, len(own), capacity)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "th", "start", "length", "ids_crc32", "doc_tokens"])

    return keyed(docs).mapInArrow(cut, "doc_id long, th long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, unit: int = 8) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cls = F.ceil(F.col("length") / unit)
    ranked = staged(
        staged(pieces(docs, tokenizer, end_id, capacity).withColumn("cls", cls), "op4-cut")  # else the range split's sampling would encode again
        .repartitionByRange(n, "cls", "doc_id", "th", "start").sortWithinPartitions("cls", "doc_id", "th", "start")
        .withColumn("row", F.monotonically_increasing_id()), "op4-pieces")
    part = F.shiftright("row", 33)
    runs = ranked.groupBy("cls", part.alias("part")).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    # The range split puts a class on neighbouring partitions: at most partitions + classes rows.
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(W.partitionBy("cls").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    histogram = {r["cls"]: r["n"] for r in ranked.groupBy("cls").agg(F.count("*").alias("n")).collect()}  # at most capacity/unit rows
    full = capacity // unit
    widths = np.array(sorted(c for c in histogram if c != full), np.int64)
    layout = plan(widths, np.array([histogram[c] for c in widths.tolist()], np.int64), full)
    places: dict[int, list[tuple[int, int, int]]] = {c: [] for c in widths.tolist()}  # class: (first rank, first sequence, pieces in a sequence)
    taken, seq = dict.fromkeys(places, 0), 0
    for a, times in layout:
        for i in np.flatnonzero(a):
            c = int(widths[i])
            places[c].append((taken[c], seq, int(a[i])))
            taken[c] += int(a[i]) * times
        seq += times
    if full in histogram:
        places[full] = [(0, seq, 1)]
    table = {c: tuple(np.array(x, np.int64) for x in zip(*v)) for c, v in places.items()}

    def assign(batches):
        for b in batches:
            c, rank = column(b, "cls").to_numpy(), column(b, "rank").to_numpy()
            out = np.empty(len(c), np.int64)
            for k in np.unique(c):
                at = np.flatnonzero(c == k)
                first, base, per = table[int(k)]
                j = np.searchsorted(first, rank[at], side="right") - 1
                out[at] = base[j] + (rank[at] - first[j]) // per[j]
            yield pa.RecordBatch.from_arrays([*(column(b, x) for x in names), pa.array(out)], names=[*names, "sequence_id"])

    names = ["doc_id", "th", "start", "length", "ids_crc32", "doc_tokens"]
    rows = ranked.withColumn("part", part).join(runs.drop("n"), ["cls", "part"])
    rows = rows.withColumn("rank", F.col("row") - F.col("first") + F.col("base")).select(*names, "cls", "rank")
    placed = rows.mapInArrow(assign, ", ".join(f"{x} long" for x in [*names, "sequence_id"]))
    before = W.partitionBy("sequence_id").orderBy("doc_id", "th", "start", "length", "ids_crc32").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("th")
