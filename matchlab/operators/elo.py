"""Elo ratings with a K factor that falls with experience: the one operator that must read its own earlier results.

Two exact ways: one grouped fold per pool (pools share no players), or, for a pool too large for a task, slices of
time whose player-connected parts are folded in parallel and whose end ratings feed the next slice; slices may also be
closed by their graph, before a part of it grows too large.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import K_BASE, K_SETS, START_RATING
from ..sources.tables import scratch, staged
from .history import segment_cuts, segment_of

RATED = "set_id long, p1_elo double, p2_elo double, p1_expected double, p1_post double, p2_post double, p1_played long, p2_played long"
#: Finer slices of a slice at most.
FINER = 1 << 20
#: Sets of a step, in the mean, from which on a fold goes by steps.
LEAST_WIDTH = 16
#: Sets of a slice: a task holds one at most, and the slices follow each other.
MOST = 1_000_000
_COLUMNS = ["set_id", "completed_at", "player1_id", "player2_id", "winner_player_id"]


def expected(a: float, b: float) -> float:
    return 1 / (1 + 10 ** ((b - a) / 400))


def k_factor(played: int) -> float:
    return K_BASE * max(1.0, 2.0 - played / K_SETS)


def fold(sets: pd.DataFrame, rating: dict, played: dict) -> pd.DataFrame:
    """Ratings before and after each set, in order; rating and played are updated. Sets of one step touch no player twice
    and have all that they need from earlier steps, so a step is a few operations on arrays; where most steps would be of
    few sets (one player in all of them), sets are taken one by one."""
    rows = sets.sort_values(["completed_at", "set_id"])
    p, q, first = rows["player1_id"].to_numpy(), rows["player2_id"].to_numpy(), (rows["winner_player_id"] == rows["player1_id"]).to_numpy()
    at, players = pd.factorize(np.r_[p, q])
    unknown = at < 0  # no id: a player that no other set has
    at[unknown] = len(players) + np.arange(int(unknown.sum()))
    i, j = at[: len(p)], at[len(p) :]
    names, step = [c.split()[0] for c in RATED.split(", ")], _steps(i, j)
    if not len(step) or len(step) < LEAST_WIDTH * int(step.max()):
        return pd.DataFrame(dict(zip(names, [rows["set_id"].to_numpy(), *_one_by_one(p, q, first, rating, played)])))
    ids = players.tolist()
    r = np.r_[np.array([rating.get(x, START_RATING) for x in ids], float), np.full(int(unknown.sum()), START_RATING)]
    m = np.r_[np.array([played.get(x, 0) for x in ids], np.int64), np.zeros(int(unknown.sum()), np.int64)]
    order = np.argsort(step, kind="stable")
    i, j, sign = i[order], j[order], np.where(first[order], 1.0, -1.0)
    out = [*(np.empty(len(p)) for _ in range(5)), *(np.empty(len(p), np.int64) for _ in range(2))]
    ends = np.cumsum(np.bincount(step)).tolist()
    for a, e in zip([0, *ends], ends):
        at_p, at_q, s = i[a:e], j[a:e], sign[a:e]
        x, y, k, n = r[at_p], r[at_q], m[at_p], m[at_q]
        d = 1 - 1 / (1 + 10 ** (s * (y - x) / 400))  # what the winner did not expect
        after_x, after_y = x + s * (K_BASE * np.maximum(1.0, 2.0 - k / K_SETS) * d), y - s * (K_BASE * np.maximum(1.0, 2.0 - n / K_SETS) * d)
        k, n = k + 1, n + 1
        r[at_p], m[at_p] = after_x, k
        r[at_q], m[at_q] = after_y, n
        for column, value in zip(out, (x, y, None, after_x, after_y, k, n)):
            if value is not None:
                column[a:e] = value
    out[2] = 1 / (1 + 10 ** ((out[1] - out[0]) / 400))
    rating.update(zip(ids, r.tolist()))
    played.update(zip(ids, m.tolist()))
    back = np.argsort(order)
    return pd.DataFrame(dict(zip(names, [rows["set_id"].to_numpy(), *(column[back] for column in out)])))


def _steps(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each set the number of sets, itself included, on the longest chain of sets that share a player and end with it."""
    last, out = [0] * (int(max(i.max(), j.max())) + 1 if len(i) else 0), []
    add = out.append
    for p, q in zip(i.tolist(), j.tolist()):
        a, b = last[p], last[q]
        a = a + 1 if a > b else b + 1
        last[p] = last[q] = a
        add(a)
    return np.array(out, np.int64)


def _one_by_one(p: np.ndarray, q: np.ndarray, won: np.ndarray, rating: dict, played: dict) -> list[list]:
    """The columns of RATED but the first; rating and played are updated."""
    out: list[list] = [[] for _ in range(7)]
    start = START_RATING
    before_a, before_b, chances, after_a, after_b, played_a, played_b = (c.append for c in out)
    for p, q, first in zip(p.tolist(), q.tolist(), won.tolist()):
        a, b, m, n = rating.get(p, start), rating.get(q, start), played.get(p, 0), played.get(q, 0)
        chance = 1 / (1 + 10 ** ((b - a) / 400))  # expected() and k_factor() in place: this loop is the ratings' cost
        k, l = K_BASE * (2.0 - m / K_SETS) if m < K_SETS else K_BASE * 1.0, K_BASE * (2.0 - n / K_SETS) if n < K_SETS else K_BASE * 1.0
        if first:
            d = 1 - chance
            x, y = a + k * d, b - l * d
        else:
            d = 1 - 1 / (1 + 10 ** ((a - b) / 400))
            x, y = a - k * d, b + l * d
        m, n = m + 1, n + 1
        rating[p], rating[q], played[p], played[q] = x, y, m, n
        before_a(a), before_b(b), chances(chance), after_a(x), after_b(y), played_a(m), played_b(n)
    return out


def elo_ratings(sets: DataFrame, pool: str | None = None, state: DataFrame | None = None) -> DataFrame:
    """One fold per value of `pool` (the whole table without it). state: player_id, rating, played (and pool) to start from."""
    key = F.col(pool) if pool else F.lit(0)
    rows = sets.select(*_COLUMNS, key.alias("pool"))
    if state is None:
        return rows.groupBy("pool").applyInPandas(lambda pdf: fold(pdf, {}, {}), RATED)
    start = state.select("player_id", "rating", "played", (F.col(pool) if pool else F.lit(0)).alias("pool"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return fold(left, dict(zip(right["player_id"], right["rating"])), dict(zip(right["player_id"], right["played"])))

    return rows.groupBy("pool").cogroup(start.groupBy("pool")).applyInPandas(run, RATED)


def end_state(sets: DataFrame, rated: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """player_id, rating, played after the last set of each player; players without a set keep their old state."""
    side = lambda i: F.struct(F.col(f"player{i}_id").alias("player_id"), F.col(f"p{i}_post").alias("rating"), F.col(f"p{i}_played").alias("played"))
    rows = sets.select("set_id", "completed_at", "player1_id", "player2_id").join(rated, "set_id").select("completed_at", "set_id", F.explode(F.array(side(1), side(2))).alias("s"))
    now = rows.groupBy("s.player_id").agg(F.max(F.struct("completed_at", "set_id", "s.rating", "s.played")).alias("m")).select("player_id", "m.rating", "m.played")
    return now if old is None else now.unionByName(old.join(now, "player_id", "left_anti").select("player_id", "rating", "played"))


def _smallest(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest player of each set's connected part: roots take the smaller root across a set, then jump to theirs."""
    players, at = np.unique(np.r_[p, q], return_inverse=True)
    p, q = at[: len(p)], at[len(p) :]
    root = np.arange(len(players))
    while len(p):
        a, b = root[p], root[q]
        apart = a != b
        p, q, a, b = p[apart], q[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return players[root[at[: len(at) // 2]]]


def _parts(pdf: pd.DataFrame, share: float | None = None, least: int = 0) -> pd.DataFrame:
    """Connected parts of one slice's player graph; bounded by the slice. With a share the slice is closed, and a finer
    one begun, once it has `least` sets and its largest part more than that share of them."""
    if not share:
        return pdf.assign(slice=pdf["slice"] * FINER, part=_smallest(pdf["player1_id"].to_numpy(), pdf["player2_id"].to_numpy()))
    rows = pdf.sort_values(["completed_at", "set_id"])
    up: dict = {}
    sets_of: dict = {}
    players = list(zip(rows["player1_id"], rows["player2_id"]))

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    finer, part, begun, largest, number = [], [], 0, 0, 0
    for i, (p, q) in enumerate(players):
        a, b = sorted((root(p), root(q)))
        up[b] = a
        sets_of[a] = sets_of.get(a, 0) + (sets_of.pop(b, 0) if a != b else 0) + 1
        largest = max(largest, sets_of[a])
        size = i + 1 - begun
        if i + 1 == len(players) or (share and size >= least and largest > share * size):
            part += [root(x) for x, _ in players[begun : i + 1]]
            finer += [number] * size
            begun, largest, number = i + 1, 0, number + 1
            up.clear()
            sets_of.clear()
    return rows.assign(slice=rows["slice"] * FINER + finer, part=part)


def elo_ratings_sliced(sets: DataFrame, seconds: int = 3600, every: int = 24, most: int | None = None, state: DataFrame | None = None, share: float | None = None, least: int = 50_000) -> DataFrame:
    """As elo_ratings without pools, for a pool beyond one task. Slices are `seconds` long or, with `most`, cut at
    quantiles of time so that each has about that many sets. Jobs grow with the number of slices, parallelism with
    the parts of a slice. Each slice writes what its players take to their next slice, which is known before any set is
    rated, so a slice reads its own sets and its own players' state alone. every: no longer needed, since no state is
    computed twice. state: player_id, rating, played to start from. share, least: close a slice by its graph, once it has
    `least` sets and its largest part more than that share of them, so that no task waits for one large part."""
    sets = staged(sets.select(*_COLUMNS), "elo-sets")  # read for the cuts and for the slices
    cuts = segment_cuts(sets, most) if most else None
    rows = sets.select(*_COLUMNS, (segment_of(cuts) if most else F.floor(F.col("completed_at") / seconds)).alias("slice"))
    cut = rows.groupBy("slice").applyInPandas(lambda pdf: _parts(pdf, share, least), rows.schema.simpleString()[7:-1].replace(":", " ") + ", part bigint")
    if cuts == [] and not share:  # one slice
        return _rated(staged(cut, "elo-slices"), state)
    return _slice_by_slice(cut, state)


def _rated(mine: DataFrame, state: DataFrame | None) -> DataFrame:
    if state is None:
        return elo_ratings(mine, pool="part")
    who = mine.select("part", F.explode(F.array("player1_id", "player2_id")).alias("player_id")).distinct()
    return elo_ratings(mine, pool="part", state=who.join(state.select("player_id", "rating", "played"), "player_id"))


def _slice_by_slice(cut: DataFrame, state: DataFrame | None) -> DataFrame:
    """Ratings of sets with slice and part, one slice after another."""
    spark = cut.sparkSession
    path = scratch(spark, "elo-rated")
    cut.write.partitionBy("slice").parquet(f"{path}/sets")
    columns = cut.drop("slice").schema
    cut = spark.read.schema(cut.schema).parquet(f"{path}/sets")
    seen = cut.select("slice", "part", F.explode(F.array("player1_id", "player2_id")).alias("player_id")).distinct()
    w = W.partitionBy("player_id").orderBy("slice")  # a row for each slice that the player is in
    seen.select("slice", "part", "player_id", F.coalesce(F.lead("part").over(w), F.lit(0)).alias("next_part"), F.lead("slice").over(w).cast("string").alias("to"), (F.row_number().over(w) == 1).alias("first")).write.partitionBy("slice").parquet(f"{path}/players")
    plan = "part long, player_id long, next_part long, to string, first boolean"
    players = spark.read.schema(plan + ", slice long").parquet(f"{path}/players")
    moves = players.filter("to is not null").select("slice", "to").distinct().collect()  # at most a pair of slices each
    came: dict[str, list[str]] = {}
    for r in moves:
        came.setdefault(r["to"], []).append(f"{path}/rated/slice={r['slice']}/to={r['to']}")
    if state is not None:
        old = players.filter("first").join(state.select("player_id", "rating", "played"), "player_id")
        _states(old, "part", "rating", "played").withColumn("to", F.col("slice").cast("string")).drop("slice").write.partitionBy("to").parquet(f"{path}/start")
        for r in spark.read.schema("to string").parquet(f"{path}/start").select("to").distinct().collect():  # a row a slice
            came.setdefault(r["to"], []).append(f"{path}/start/to={r['to']}")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known, asked = right[right["played"] >= 0], right[right["to"].notna()]
        rating, played = dict(zip(known["player_id"].tolist(), known["rating"].tolist())), dict(zip(known["player_id"].tolist(), known["played"].tolist()))
        out = fold(left, rating, played).assign(to="rated")
        who = asked["player_id"].tolist()
        onwards = pd.DataFrame({"set_id": who, "p1_elo": [rating[p] for p in who], "p1_played": [played[p] for p in who], "p2_played": asked["next_part"].tolist(), "to": asked["to"].tolist()})
        zeros = {c: 0.0 for c in ("p2_elo", "p1_expected", "p1_post", "p2_post")}
        return pd.concat([out, onwards.assign(**zeros)[list(out.columns)]]) if who else out

    order = [r["slice"] for r in cut.select("slice").distinct().orderBy("slice").collect()]  # one row per slice
    for at in order:
        mine = spark.read.schema(columns).parquet(f"{path}/sets/slice={at}")
        right = spark.read.schema(plan).parquet(f"{path}/players/slice={at}").select("part", "player_id", "next_part", "to", F.lit(0.0).alias("rating"), F.lit(-1).cast("long").alias("played"))
        if str(at) in came:
            right = right.unionByName(_moved(spark.read.schema(RATED).parquet(*came[str(at)])))
        rated = mine.groupBy("part").cogroup(right.groupBy("part")).applyInPandas(run, RATED + ", to string")
        rated.write.partitionBy("to").parquet(f"{path}/rated/slice={at}")
    return spark.read.schema(RATED).parquet(*(f"{path}/rated/slice={at}/to=rated" for at in order)) if order else spark.createDataFrame([], RATED)


def _states(df: DataFrame, part: str, rating: str, played: str) -> DataFrame:
    """Players' states in the columns of RATED, so that a slice writes both in one job: set_id is the player, p2_played
    the part of the slice to come."""
    zero = [F.lit(0.0).alias(c) for c in ("p2_elo", "p1_expected", "p1_post", "p2_post")]
    return df.select(F.col("player_id").alias("set_id"), F.col(rating).alias("p1_elo"), *zero, F.col(played).alias("p1_played"), F.col(part).alias("p2_played"), "slice")


def _moved(states: DataFrame) -> DataFrame:
    return states.select(F.col("p2_played").alias("part"), F.col("set_id").alias("player_id"), F.lit(0).cast("long").alias("next_part"), F.lit(None).cast("string").alias("to"), F.col("p1_elo").alias("rating"), F.col("p1_played").alias("played"))


def elo_ratings_bounded(sets: DataFrame, most: int = MOST, state: DataFrame | None = None) -> DataFrame:
    """As elo_ratings without pools; no task holds more than about `most` sets, but of sets of one second."""
    return elo_ratings_sliced(sets, most=most, state=state)
