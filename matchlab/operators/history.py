"""Features from each player's and pair's history strictly before a set; order is (completed_at, set_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ORDER = ["completed_at", "set_id"]


def completed_sets(sets: DataFrame, events: DataFrame, tournaments: DataFrame) -> DataFrame:
    """Decided, dated sets with their event and tournament."""
    e = events.select(F.col("id").alias("event_id"), "tournament_id")
    t = tournaments.select(F.col("id").alias("tournament_id"), F.col("name").alias("tournament_name"), "num_attendees")
    rows = sets.filter(F.col("winner_player_id").isNotNull() & F.col("completed_at").isNotNull()).withColumnRenamed("id", "set_id")
    return rows.join(e.join(t, "tournament_id"), "event_id")


def long_form(sets: DataFrame) -> DataFrame:
    """One row per player and set: set_id, completed_at, slot, player_id, won."""
    side = lambda i: F.struct(F.lit(i).alias("slot"), F.col(f"player{i}_id").alias("player_id"))
    kept = ["set_id", "completed_at", *(["segment"] if "segment" in sets.columns else [])]
    rows = sets.select(*kept, "winner_player_id", F.explode(F.array(side(1), side(2))).alias("s"))
    return rows.select(*kept, "s.*", (F.col("winner_player_id") == F.col("s.player_id")).cast("int").alias("won"))


def segment_cuts(sets: DataFrame, most: int) -> list[int]:
    """Times at quantiles, between which about `most` sets lie, but for sets of one second; none for fewer sets."""
    n = -(-sets.count() // most)
    return sorted(set(sets.agg(F.percentile_approx("completed_at", [i / n for i in range(1, n)], 10_000)).first()[0])) if n > 1 else []


def segment_of(cuts: list[int]) -> Column:
    """Number of the time segment of a set: comparisons by halves, as many as the binary digits of the cuts' number."""
    def pick(a: int, e: int) -> Column:
        if a == e:
            return F.lit(a)
        mid = (a + e) // 2
        return F.when(F.col("completed_at") < cuts[mid], pick(a, mid)).otherwise(pick(mid + 1, e))

    return pick(0, len(cuts)).cast("long")


def _tail(results: Column, n: Column | int) -> Column:
    """The last n of an array."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(results, F.greatest(F.size(results) - n + 1, F.lit(1)), n)


def player_history(long: DataFrame, n: int = 30, state: DataFrame | None = None) -> DataFrame:
    """set_id, slot, prior sets played, and the mean of the last n prior results (0.5 without any).

    With a column `segment` (of time), a player's history is a prefix scan over segments: each one is folded to its count
    and last n results, these are carried over the player's earlier segments, and rows are finished within theirs. So a
    player of a third of all sets fills no task. state: player_state of earlier sets to go on from."""
    if "segment" not in long.columns and state is None:
        w = W.partitionBy("player_id").orderBy(*ORDER)
        return long.select("set_id", "slot", (F.row_number().over(w) - 1).cast("long").alias("sets_played"), F.coalesce(F.avg("won").over(w.rowsBetween(-n, -1)), F.lit(0.5)).alias("recent_wr"))
    rows = long if "segment" in long.columns else long.withColumn("segment", F.lit(0).cast("long"))
    key = ["player_id", "segment"]
    w = W.partitionBy(*key).orderBy(*ORDER)
    rows = rows.withColumn("_i", F.row_number().over(w) - 1).withColumn("_s", F.coalesce(F.sum("won").over(w.rowsBetween(-n, -1)), F.lit(0)))
    back = F.row_number().over(W.partitionBy(*key).orderBy(*(F.desc(c) for c in ORDER)))
    last = rows.withColumn("_back", back).filter(F.col("_back") <= n).groupBy(*key).agg((F.max("_i") + 1).alias("_n"), F.transform(F.sort_array(F.collect_list(F.struct("_i", "won"))), lambda x: x["won"]).alias("_last"))
    over = W.partitionBy("player_id").orderBy("segment")  # a row a segment; n earlier ones hold n results
    carry = last.select(*key, F.coalesce(F.sum("_n").over(over.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.flatten(F.collect_list("_last").over(over.rowsBetween(-n, -1))).alias("_ring"))
    if state is not None:
        old = state.select("player_id", F.col("sets_played").alias("_old"), F.col("recent").alias("_old_ring"))
        none = F.array().cast("array<int>")
        carry = carry.join(old, "player_id", "left").select(*key, (F.col("_before") + F.coalesce("_old", F.lit(0))).alias("_before"), F.concat(F.coalesce("_old_ring", none), "_ring").alias("_ring"))
    rows = rows.join(carry.withColumn("_ring", _tail(F.col("_ring"), n)), key)
    inside = F.least(F.col("_i"), F.lit(n))
    earlier = _tail(F.col("_ring"), n - inside)
    total, count = F.col("_s") + F.aggregate(earlier, F.lit(0).cast("long"), lambda a, x: a + x), inside + F.size(earlier)
    return rows.select("set_id", "slot", (F.col("_before") + F.col("_i")).cast("long").alias("sets_played"), F.coalesce(F.try_divide(total.cast("double"), count.cast("double")), F.lit(0.5)).alias("recent_wr"))


def player_state(long: DataFrame, n: int = 30, state: DataFrame | None = None) -> DataFrame:
    """player_id, sets_played, recent: each player's number of sets and last n results, oldest first, after all of these
    sets; state: after earlier ones."""
    back = F.row_number().over(W.partitionBy("player_id").orderBy(*(F.desc(c) for c in ORDER)))  # cut to n within tasks first
    last = long.withColumn("_back", back).filter(F.col("_back") <= n).groupBy("player_id").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("b"), "won"))), lambda x: x["won"]).alias("recent"))
    now = long.groupBy("player_id").agg(F.count("*").alias("sets_played")).join(last, "player_id")
    if state is None:
        return now.select("player_id", "sets_played", "recent")
    none = F.array().cast("array<int>")
    both = now.join(state.select("player_id", F.col("sets_played").alias("_old"), F.col("recent").alias("_ring")), "player_id", "full")
    return both.select("player_id", (F.coalesce("sets_played", F.lit(0)) + F.coalesce("_old", F.lit(0))).alias("sets_played"), _tail(F.concat(F.coalesce("_ring", none), F.coalesce("recent", none)), n).alias("recent"))


def _by_pair(sets: DataFrame) -> DataFrame:
    """player_a is the smaller id; _a: it won."""
    a = F.least("player1_id", "player2_id")
    return sets.withColumn("player_a", a).withColumn("player_b", F.greatest("player1_id", "player2_id")).withColumn("_a", (F.col("winner_player_id") == a).cast("long"))


def prior_h2h(sets: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The sets with the pair's prior wins by slot; a column `segment` and a state are used as in player_history."""
    pair = ["player_a", "player_b"]
    rows = _by_pair(sets)
    key = [*pair, "segment"] if "segment" in sets.columns else pair
    before = W.partitionBy(*key).orderBy(*ORDER).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(before)).withColumn("_l", F.coalesce(F.sum("_a").over(before), F.lit(0)))
    carry = None
    if "segment" in sets.columns:
        over = W.partitionBy(*pair).orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
        per = _by_pair(sets).groupBy(*key).agg(F.count("*").alias("_m"), F.sum("_a").alias("_w"))
        carry = per.select(*key, F.coalesce(F.sum("_m").over(over), F.lit(0)).alias("_bn"), F.coalesce(F.sum("_w").over(over), F.lit(0)).alias("_bl"))
        rows = rows.join(carry, key).withColumn("_n", F.col("_n") + F.col("_bn")).withColumn("_l", F.col("_l") + F.col("_bl")).drop("_bn", "_bl")
    if state is not None:
        old = state.select(*pair, F.col("sets").alias("_on"), F.col("a_wins").alias("_ol"))
        rows = rows.join(old, pair, "left").withColumn("_n", F.col("_n") + F.coalesce("_on", F.lit(0))).withColumn("_l", F.col("_l") + F.coalesce("_ol", F.lit(0))).drop("_on", "_ol")
    one = F.when(F.col("player1_id") == F.col("player_a"), F.col("_l")).otherwise(F.col("_n") - F.col("_l"))
    return rows.select(*sets.columns, one.alias("p1_h2h_wins"), (F.col("_n") - one).alias("p2_h2h_wins"), F.col("_n").alias("h2h_total"))


def pair_state(sets: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """player_a, player_b, sets, a_wins: each pair's record after all of these sets; state: after earlier ones."""
    now = _by_pair(sets).groupBy("player_a", "player_b").agg(F.count("*").alias("sets"), F.sum("_a").alias("a_wins"))
    return now if state is None else now.unionByName(state).groupBy("player_a", "player_b").agg(F.sum("sets").alias("sets"), F.sum("a_wins").alias("a_wins"))


def history_features(completed: DataFrame, n: int = 30, most: int | None = None, players: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """completed_sets with experience, form, head-to-head, seed and target columns. most: sets of a time segment, beyond
    which histories are scanned by segments; players, pairs: states after earlier sets."""
    if most and (cuts := segment_cuts(completed, most)):
        completed = completed.withColumn("segment", segment_of(cuts))
    h = player_history(long_form(completed), n, players)
    pick = lambda c, i: F.max(F.when(F.col("slot") == i, F.col(c)))
    wide = h.groupBy("set_id").agg(*(pick(c, i).alias(f"p{i}_{c}") for i in (1, 2) for c in ("sets_played", "recent_wr")))
    rows = prior_h2h(completed, pairs).join(wide, "set_id")
    rate = F.coalesce(F.try_divide(F.col("p1_h2h_wins").cast("double"), F.col("h2h_total").cast("double")), F.lit(0.5))
    return rows.withColumns({
        "recent_wr_diff": F.col("p1_recent_wr") - F.col("p2_recent_wr"), "p1_h2h_wr": rate, "p1_seed": F.col("player1_seed").cast("long"), "p2_seed": F.col("player2_seed").cast("long"),
        "seed_diff": F.coalesce(F.col("player1_seed"), F.lit(0)).cast("long") - F.coalesce(F.col("player2_seed"), F.lit(0)).cast("long"), "num_attendees": F.coalesce(F.col("num_attendees"), F.lit(0)).cast("long"),
        "p1_score": F.col("player1_score"), "p2_score": F.col("player2_score"), "p1_won": (F.col("winner_player_id") == F.col("player1_id")).cast("int"),
    }).drop("segment")
