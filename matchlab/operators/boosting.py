"""Boosted trees of second order by histograms, grown level by level, any number of models at once.

One quantile sketch gives each feature's bin borders; rows become blocks of bin numbers, stored once, each block in the
order of time, so that a model reads its rows as the first ones of a block. For every level of a tree each task adds its rows' gradients and hessians by model, node, feature and bin, and only the sums meet: on the
driver while all tasks' sums are small (`most_bytes`), else in tasks that each get a part of the nodes, so that splits
alone reach the driver. All models take their next level in the same job, wherever each of them stands, and the loss is
summed along with a tree's first level: the number of jobs is that of the levels of the model with the most of them, plus
one to see its last loss, plus one every `store_every` trees to store the margins. Sums are whole numbers (2^-30 units, up to eight billion rows), so neither the number of tasks nor
their order changes a model.

A null feature counts as the smallest value. Without rows to train on a model is its base alone.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import scratch, staged

SCALE = 1 << 30
BLOCK_ROWS = 8192
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Setting:
    trees: int = 300
    depth: int = 5
    rate: float = 0.05
    rows: float = 0.8  # share of the rows drawn for each tree
    columns: float = 0.8  # share of the features drawn for each tree
    min_hessian: float = 10.0
    alpha: float = 0.0  # absolute and squared penalty of a leaf's weight
    lam: float = 1.0
    patience: int = 20
    seed: int = 42


class Tree:
    """Nodes in heap order: the children of i are 2i+1 and 2i+2. A leaf's feature is -1."""

    def __init__(self, depth: int):
        n = 2 ** (depth + 1) - 1
        self.feature, self.bin = np.full(n, -1, np.int16), np.zeros(n, np.int16)
        self.threshold, self.value, self.cover, self.gain = (np.zeros(n) for _ in range(4))

    def leaf_of(self, right) -> np.ndarray:
        """Node that each row ends in; right(rows, features, nodes) tells which of the rows turn right."""
        node, live = None, None
        for _ in range(int(math.log2(len(self.feature) + 1)) - 1):
            if node is None:
                if self.feature[0] < 0:
                    break
                turn = right(slice(None), np.int64(self.feature[0]), 0)
                node = 1 + turn.astype(np.int64)
                continue
            live = np.flatnonzero(self.feature[node] >= 0)
            if not len(live):
                break
            at = node[live]
            node[live] = 2 * at + 1 + right(live, self.feature[at].astype(np.int64), at)
        return node

    def by_bin(self, bins: np.ndarray) -> np.ndarray:
        node = self.leaf_of(lambda rows, f, at: bins[rows, f] > self.bin[at])
        return np.zeros(len(bins), np.int64) if node is None else node

    def by_column(self, columns: np.ndarray) -> np.ndarray:
        """As by_bin, of bins by feature and row: all rows go down together, from a leaf to its left, and back to it. A
        level's nodes compare their whole columns at once; one bit a level tells a row's way."""
        n, inner = columns.shape[1], self.feature >= 0
        levels = int(np.flatnonzero(inner).max() + 1).bit_length() if inner.any() else 0
        way, limit, here = np.zeros(n, np.uint8 if levels <= 8 else np.int64), np.where(inner, self.bin, 255).astype(np.uint8)[:, None], np.ones((1, n), bool)
        for level in range(levels):
            nodes = slice(2**level - 1, 2 ** (level + 1) - 1)
            right = columns[np.maximum(self.feature[nodes], 0)] > limit[nodes]
            right &= here
            way += way
            way += np.logical_or.reduce(right, axis=0)
            if level + 1 < levels:  # rows at each node of the next level
                left, here = here > right, np.empty((2 << level, n), bool)
                here[0::2], here[1::2] = left, right
        end = np.zeros(2 ** (levels + 1) - 1, np.int64)
        for i in range(1, len(end)):
            end[i] = i if inner[(i - 1) // 2] else end[(i - 1) // 2]
        return end[2**levels - 1 :].take(way)

    def by_value(self, x: np.ndarray) -> np.ndarray:
        node = self.leaf_of(lambda rows, f, at: x[rows, f] > self.threshold[at])
        return np.zeros(len(x), np.int64) if node is None else node


@dataclass
class Boosted:
    """A fitted model: log odds are the base plus the leaves' values."""

    features: list[str]
    base: float
    trees: list[Tree]
    setting: Setting
    jobs: int = 0  # Spark jobs of the fit that this model was part of
    losses: list[float] = field(default_factory=list)  # on the rows held out for stopping, after 0, 1, ... trees

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.value[t.by_value(x)]
        return out

    def table(self) -> list[tuple]:
        """Rows of NODES."""
        return [(i, k, int(t.feature[k]), float(t.threshold[k]), float(t.value[k]), float(t.cover[k]), float(t.gain[k])) for i, t in enumerate(self.trees) for k in np.flatnonzero(t.cover).tolist()]


NODES = "tree int, node int, feature int, threshold double, value double, cover double, gain double"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lots(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A tree's lot of each row, by a hash of row, seed and tree."""
    return _mix(ids.view(np.uint64) ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)


def drawn(ids: np.ndarray, setting: Setting, tree: int, lot: np.ndarray | None = None) -> np.ndarray:
    """Rows of a tree's sample, by their lots."""
    return (lots(ids, setting.seed, tree) if lot is None else lot) < np.uint64(min(setting.rows, 1.0) * (1 << 53))


def drawn_columns(n: int, setting: Setting, tree: int) -> list[int]:
    k = max(1, int(setting.columns * n))
    return sorted(np.random.default_rng([setting.seed, tree]).permutation(n)[:k].tolist())


def weight(g, h, s: Setting):
    """A leaf's value: the step against the gradient, shrunk by both penalties and the rate."""
    return -s.rate * np.sign(g) * np.maximum(np.abs(g) - s.alpha, 0) / np.maximum(h + s.lam, 1e-300)


def best_splits(sums: np.ndarray, s: Setting) -> np.ndarray:
    """For each node (gain, column, bin, left gradient, left hessian, gradient, hessian) of its best split. sums: whole
    numbers by node, column, bin and (gradient, hessian). Equal gains go to the first column, then the first bin."""
    worth = lambda g, h: np.maximum(np.abs(g) - s.alpha, 0) ** 2 / np.maximum(h + s.lam, 1e-300)
    total = sums[:, 0].sum(1) / SCALE
    left = np.cumsum(sums, axis=2)[:, :, :-1] / SCALE
    g, h = left[..., 0], left[..., 1]
    rest_g, rest_h = total[:, None, None, 0] - g, total[:, None, None, 1] - h
    gain = worth(g, h) + worth(rest_g, rest_h) - worth(total[:, 0], total[:, 1])[:, None, None]
    gain[(np.minimum(h, rest_h) < s.min_hessian) | (h <= 0) | (rest_h <= 0)] = -np.inf
    flat = gain.reshape(len(sums), -1)
    if not flat.shape[1]:
        return np.c_[np.full((len(sums), 1), -np.inf), np.zeros((len(sums), 4)), total]
    k = flat.argmax(1)
    col, b = np.divmod(k, gain.shape[2])
    n = np.arange(len(sums))
    return np.c_[flat[n, k], col, b, g[n, col, b], h[n, col, b], total]


class _Growing:
    """One model on its way."""

    def __init__(self, setting: Setting, span: tuple[float, float, float], base: float, n_features: int):
        self.s, self.span, self.base, self.n = setting, span, base, n_features
        self.trees: list[Tree] = []
        self.stored = 0  # trees whose values are in the stored margins
        self.losses: list[float] = []
        self.tree: Tree | None = None
        self.frontier: list[int] = []
        self.done = not math.isfinite(base)
        if self.done:
            self.base = 0.0

    def ask(self) -> dict:
        """What the next job must sum for this model."""
        if self.tree is None and len(self.trees) < self.s.trees:
            self.tree, self.frontier = Tree(self.s.depth), [0]
            self.columns = drawn_columns(self.n, self.s, len(self.trees))
        return {"s": self.s, "span": self.span, "pending": self.trees[self.stored :], "tree": self.tree, "number": len(self.trees), "frontier": self.frontier if self.tree else [], "columns": getattr(self, "columns", []), "loss": len(self.losses) <= len(self.trees)}

    def take(self, splits: dict[int, np.ndarray], loss: tuple[int, int] | None, edges: list[np.ndarray]) -> None:
        if loss is not None:
            total, n = loss
            self.losses.append(total / SCALE / n if n else math.nan)
            best = int(np.nanargmin(self.losses)) if n else len(self.losses) - 1
            if len(self.trees) >= self.s.trees or len(self.losses) - 1 - best >= self.s.patience:
                self.trees, self.done = self.trees[: best if n else None], True
                return
        t, s, onwards = self.tree, self.s, []
        for node in self.frontier:
            gain, col, b, g, h, all_g, all_h = splits[node].tolist()
            if node == 0:
                t.value[0], t.cover[0] = weight(all_g, all_h, s), all_h
            if not gain > LEAST_GAIN:
                continue
            f, b = self.columns[int(col)], int(b)
            t.feature[node], t.bin[node], t.threshold[node], t.gain[node] = f, b, edges[f][b], gain
            for child, cg, ch in ((2 * node + 1, g, h), (2 * node + 2, all_g - g, all_h - h)):
                t.value[child], t.cover[child] = weight(cg, ch, s), ch
                if 2 * child + 2 < len(t.feature) and ch >= 2 * s.min_hessian:
                    onwards.append(child)
        self.frontier = onwards
        if not onwards:
            self.trees.append(t)
            self.tree = None


def _margins(stored: np.ndarray, columns: np.ndarray, pending: list[Tree]) -> np.ndarray:
    out = stored.copy()
    for t in pending:
        out += t.value.take(t.by_column(columns))
    return out


def _blocks(batches):
    """The stored blocks as numpy columns."""
    for b in batches:
        for i in range(b.num_rows):
            n, ids, y, at, bins, margins = (b.column(k)[i].as_py() for k in range(6))
            columns = np.ascontiguousarray(np.frombuffer(bins, np.uint8).reshape(n, -1).T)  # of all models' trees
            yield n, np.frombuffer(ids, np.int64), np.frombuffer(y, np.float64), np.frombuffer(at, np.float64), columns, np.frombuffer(margins, np.float64).reshape(-1, n)


BLOCKS = "n int, ids binary, y binary, at binary, bins binary, margins binary"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
READ = "spark.sql.parquet.columnarReaderBatchSize"  # rows that the reader holds unpacked; margins pack well, so row groups don't bound it
SUMS = "key long, loss long, n long, sums binary"
CHUNK = 32  # nodes in a row of sums
#: Bytes of blocks or sums that Spark hands to a task's Python at once, and of a stored row group: a block has the margins of
#: all models, so a partition's blocks together are large.
BATCH_BYTES = 16 << 20
STORED = {"parquet.block.size": str(BATCH_BYTES), "parquet.page.size.row.check.min": "1"}
EXACT = 512  # blocks whose sums are whole numbers below 2^53


def _partial(asks: dict[int, dict], width: int):
    """Sums of a task's rows: a row for each model and CHUNK of nodes."""

    def run(batches):
        sums = {m: np.zeros((len(a["frontier"]), len(a["columns"]), width, 2), np.int64) for m, a in asks.items()}
        held = {m: np.zeros((len(a["columns"]), 2, len(a["frontier"]) * width)) for m, a in asks.items()}
        losses = {m: [0, 0] for m in asks}

        def move():
            for m, x in held.items():
                if x.size:
                    sums[m] += x.reshape(*x.shape[:2], -1, width).transpose(2, 0, 3, 1).astype(np.int64)
                    x[:] = 0

        for number, (_, ids_all, y_all, at_all, columns_all, margins) in enumerate(_blocks(batches)):
            if number % EXACT == EXACT - 1:
                move()
            known = {}  # models of one seed that are at the same tree draw by the same lots
            for m, a in asks.items():
                train, first, last = a["span"]
                n = int(np.searchsorted(at_all, max(train, last) if a["loss"] else train))  # later rows are nothing to this model
                if not n:
                    continue
                at, columns, ids, y = at_all[:n], columns_all[:, :n], ids_all[:n], y_all[:n]
                margin = _margins(margins[m, :n], columns, a["pending"])
                p = 1 / (1 + np.exp(-margin))
                if a["loss"]:
                    late = (at >= first) & (at < last)
                    q = np.clip(np.where(y[late] > 0, p[late], 1 - p[late]), 1e-15, None)
                    losses[m][0] += int(np.rint(-np.log(q) * SCALE).astype(np.int64).sum())
                    losses[m][1] += int(late.sum())
                k = len(a["frontier"])
                if not k:
                    continue
                place = np.full(len(a["tree"].feature), -1)
                place[a["frontier"]] = np.arange(k)
                own = place.take(a["tree"].by_column(columns))
                lot = a["s"].seed, a["number"]
                if lot not in known:
                    known[lot] = lots(ids_all, *lot)
                use = np.flatnonzero((at < train) & (own >= 0) & drawn(ids, a["s"], a["number"], known[lot][:n]))
                base, p, y_used = own.take(use) * width, p.take(use), y.take(use)
                weights = [np.rint(w * SCALE) for w in (p - y_used, p * (1 - p))]
                for j, f in enumerate(a["columns"]):
                    cell = base + columns[f].take(use)
                    for c, w in enumerate(weights):
                        held[m][j, c] += np.bincount(cell, w, k * width)
        move()
        held.clear()
        for m in asks:  # a few nodes at once, and a model's sums go as soon as they are given out
            own = sums.pop(m)
            for i in range(0, max(1, len(own)), CHUNK):
                row = (m << 16 | i, *(losses[m] if i == 0 else (0, 0)))
                yield pa.RecordBatch.from_arrays([*(pa.array([c], pa.int64()) for c in row), pa.array([own[i : i + CHUNK].tobytes()], pa.binary())], names=["key", "loss", "n", "sums"])

    return run


def _added(rows, asks: dict[int, dict], width: int):
    """(key, loss, n, best splits) from rows of SUMS in which equal keys follow each other."""
    last, loss, n, held = None, 0, 0, None

    def out():
        a = asks[last >> 16]
        return last, loss, n, best_splits(held, a["s"]) if len(held) else np.empty((0, 7))

    for key, x, k, blob in rows:
        part = np.frombuffer(blob, np.int64).reshape(-1, max(1, len(asks[key >> 16]["columns"])), width, 2)
        if key == last:
            loss, n, held = loss + x, n + k, held + part
        else:
            if last is not None:
                yield out()
            last, loss, n, held = key, x, k, part
    if last is not None:
        yield out()


def _level(blocks: DataFrame, parts: int, asks: dict[int, dict], width: int, most_bytes: int) -> list[tuple]:
    """One job: sums by task, added up, and the best split of each node."""
    sums = blocks.mapInArrow(_partial(asks, width), SUMS)
    size = sum(len(a["frontier"]) * len(a["columns"]) * width * 16 + 64 for a in asks.values())
    if size * parts <= most_bytes:
        rows = sorted(((r["key"], r["loss"], r["n"], bytes(r["sums"])) for r in sums.collect()), key=lambda r: r[0])
        return list(_added(rows, asks, width))

    def add(batches):
        rows = ((k.as_py(), x.as_py(), n.as_py(), s.as_py()) for b in batches for k, x, n, s in zip(*b.columns))
        for key, loss, n, splits in _added(rows, asks, width):
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([loss]), pa.array([n]), pa.array([splits.tobytes()], pa.binary())], names=["key", "loss", "n", "sums"])

    met = sums.repartition("key").sortWithinPartitions("key").mapInArrow(add, SUMS)
    return [(r["key"], r["loss"], r["n"], np.frombuffer(bytes(r["sums"])).reshape(-1, 7)) for r in met.collect()]


def bin_edges(df: DataFrame, features: list[str], most_bins: int = 64, accuracy: int = 10_000) -> list[np.ndarray]:
    """Upper borders of each feature's bins but the last, from one sketch a feature: at most most_bins - 1 numbers each."""
    shares = [i / most_bins for i in range(1, most_bins)]
    ends = [F.percentile_approx(f, shares, accuracy).alias(f"q{i}") for i, f in enumerate(features)] + [F.max(f).alias(f"m{i}") for i, f in enumerate(features)]
    row = df.agg(*ends).first()
    out = []
    for i in range(len(features)):
        x = np.unique(np.array(row[f"q{i}"] or [], float))
        out.append(x[x < row[f"m{i}"]] if len(x) else x)
    return out


def _stored_blocks(df: DataFrame, features: list[str], edges: list[np.ndarray], bases: list[float], key: str, label: str, time: str, parts: int) -> DataFrame:
    def cut(batches):
        held: list[pd.DataFrame] = []

        def out(pdf):
            pdf = pdf.sort_values("_at", kind="stable")
            x = pdf[features].to_numpy(float)
            bins = np.empty(x.shape, np.uint8)
            for j, e in enumerate(edges):
                bins[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(e, x[:, j], side="left"))
            n = len(pdf)
            margins = np.repeat(np.array(bases)[:, None], n, 1)
            return pd.DataFrame([(n, pdf["_id"].to_numpy(np.int64).tobytes(), pdf["_y"].to_numpy(float).tobytes(), pdf["_at"].to_numpy(float).tobytes(), bins.tobytes(), margins.tobytes())], columns=[c.split()[0] for c in BLOCKS.split(", ")])

        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= BLOCK_ROWS:
                whole = pd.concat(held)
                for i in range(0, len(whole) - BLOCK_ROWS + 1, BLOCK_ROWS):
                    yield out(whole.iloc[i : i + BLOCK_ROWS])
                held = [whole.iloc[len(whole) // BLOCK_ROWS * BLOCK_ROWS :]]
        if held and len(rest := pd.concat(held)):
            yield out(rest)

    rows = df.select(F.xxhash64(key).alias("_id"), F.col(label).cast("double").alias("_y"), F.col(time).cast("double").alias("_at"), *(F.col(f).cast("double").alias(f) for f in features))
    return staged(rows.filter("_y is not null and _at is not null").repartition(parts, "_id").mapInPandas(cut, BLOCKS), "boost-blocks", **STORED)


def fit(df: DataFrame, features: list[str], settings: list[Setting], spans: list[tuple[float, float, float]], key: str = "set_id", label: str = "p1_won", time: str = "completed_at", most_bins: int = 64, store_every: int | None = None, most_bytes: int = 64 << 20, parts: int | None = None, edges: list[np.ndarray] | None = None) -> list[Boosted]:
    """A model for each setting and span (train on rows before the first time; stop by the loss on those from the second
    to before the third, or never where there is none). Bin borders are shared: they come from the features, not the
    labels, of all rows that some model trains on, unless they are given."""
    spark = df.sparkSession
    before = {k: spark.conf.get(k, None) for k in (BATCH, READ)}
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        return _fitted(df, features, settings, spans, key, label, time, most_bins, store_every, most_bytes, parts, edges)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _fitted(df, features, settings, spans, key, label, time, most_bins, store_every, most_bytes, parts, edges) -> list[Boosted]:
    spark = df.sparkSession
    t, y = F.col(time).cast("double"), F.col(label).cast("double")
    counts = df.filter(y.isNotNull() & t.isNotNull()).agg(F.count("*").alias("n"), *(x for i, s in enumerate(spans) for x in (F.count(F.when(t < float(s[0]), y)).alias(f"n{i}"), F.sum(F.when(t < float(s[0]), y)).alias(f"y{i}")))).first()
    odds = lambda n, k: math.log((k + 0.5) / (n - k + 0.5)) if n else math.nan
    models = [_Growing(s, span, odds(counts[f"n{i}"], counts[f"y{i}"] or 0), len(features)) for i, (s, span) in enumerate(zip(settings, spans))]
    latest = max((float(s[0]) for s in spans), default=0.0)
    edges = bin_edges(df.filter(t < latest), features, most_bins) if edges is None else edges
    width = max([len(e) for e in edges], default=0) + 1
    parts = parts or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counts["n"] // (2 * BLOCK_ROWS))))
    blocks = _stored_blocks(df, features, edges, [m.base for m in models], key, label, time, parts)
    spark.conf.set(READ, str(blocks_at_once(len(models), len(features))))
    if store_every is None:  # a level of many models reads trees that are not stored for longer than a job takes
        store_every = 2 if counts["n"] * len(models) > 20_000_000 else 8
    turns = [scratch(spark, "boost-margins") for _ in range(2)]  # written by turns: the older margins are overwritten
    jobs, moves = 3, 0
    while True:
        live = {i: m for i, m in enumerate(models) if not m.done}
        if not live:
            break
        if any(len(m.trees) - m.stored >= store_every for m in live.values()):
            blocks = _advanced(blocks, {i: (m.trees[m.stored :], max(m.span[0], m.span[2])) for i, m in live.items()}, turns[moves % 2])
            jobs, moves = jobs + 1, moves + 1
            for m in live.values():
                m.stored = len(m.trees)
        asks = {i: m.ask() for i, m in live.items()}
        splits: dict[int, dict[int, np.ndarray]] = {i: {} for i in live}
        losses = {i: [0, 0] for i in live}
        for k, loss, n, found in _level(blocks, parts, asks, width, most_bytes):
            i, first = k >> 16, k & 0xFFFF
            losses[i] = [losses[i][0] + loss, losses[i][1] + n]
            splits[i].update(zip(asks[i]["frontier"][first:], found))
        jobs += 1
        for i, m in live.items():
            m.take(splits[i], tuple(losses[i]) if asks[i]["loss"] else None, edges)
    return [Boosted(list(features), m.base, m.trees, m.s, jobs, m.losses) for m in models]


def blocks_at_once(models: int, features: int) -> int:
    return max(1, BATCH_BYTES // (BLOCK_ROWS * (8 * models + features + 24)))


def _advanced(blocks: DataFrame, pending: dict[int, tuple[list[Tree], float]], path: str) -> DataFrame:
    """The blocks with the values of more trees in the margins of rows before each model's last time."""

    def run(batches):
        for b in batches:
            new = []
            for _, _, _, at, columns, margins in _blocks([b]):
                out = margins.copy()
                for i, (trees, until) in pending.items():
                    k = int(np.searchsorted(at, until))
                    out[i, :k] = _margins(margins[i, :k], columns[:, :k], trees)
                new.append(out.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(new, pa.binary())], names=b.schema.names)

    blocks.mapInArrow(run, BLOCKS).write.mode("overwrite").options(**STORED).parquet(path)
    return blocks.sparkSession.read.schema(blocks.schema).parquet(path)


def probabilities(models: list[Boosted], df: DataFrame, name: str = "probs") -> DataFrame:
    """df with an array of each model's chance of the label; the models are bounded by their trees."""
    features = models[0].features

    @F.pandas_udf("array<double>")
    def run(x: pd.DataFrame) -> pd.Series:
        v = x.to_numpy(float)
        return pd.Series(list(np.stack([1 / (1 + np.exp(-m.margin(v))) for m in models], 1))) if len(v) else pd.Series([], dtype=object)

    return df.withColumn(name, run(F.struct(*(F.col(f).cast("double").alias(f) for f in features))))


def importances(model: Boosted) -> dict[str, float]:
    """Each feature's mean gain of a split, as a share of the sum."""
    total, n = np.zeros(len(model.features)), np.zeros(len(model.features))
    for t in model.trees:
        k = t.feature >= 0
        np.add.at(total, t.feature[k], t.gain[k])
        np.add.at(n, t.feature[k], 1)
    mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
    return dict(zip(model.features, (mean / (mean.sum() or 1)).tolist()))


def save(model: Boosted, path: str, spark) -> None:
    """Nodes as Parquet, and what describes the model as one JSON row."""
    spark.createDataFrame(model.table(), NODES).write.mode("overwrite").parquet(f"{path}/nodes")
    about = json.dumps({"features": model.features, "base": model.base, "trees": len(model.trees), "setting": asdict(model.setting), "losses": [x if math.isfinite(x) else None for x in model.losses]})
    spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(path: str, spark) -> Boosted:
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    setting = Setting(**about["setting"])
    trees = [Tree(setting.depth) for _ in range(about["trees"])]
    for r in spark.read.schema(NODES).parquet(f"{path}/nodes").collect():  # bounded by the model
        t, k = trees[r["tree"]], r["node"]
        t.feature[k], t.threshold[k], t.value[k], t.cover[k], t.gain[k] = r["feature"], r["threshold"], r["value"], r["cover"], r["gain"]
    return Boosted(about["features"], about["base"], trees, setting, losses=[math.nan if x is None else x for x in about["losses"]])
