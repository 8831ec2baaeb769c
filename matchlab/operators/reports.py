"""Descriptive reports over tournaments, sets, games and players."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import bucket, ratio, tier
from ..sources.tables import decided, table_stats

# The report's edges, common score lines and tiers in their order.
SEED_GAPS = [0, 2, 5, 10, 25, 50, 100, 5000]
SEED_GAP_LABELS = ["1-2", "3-5", "6-10", "11-25", "26-50", "51-100", "100+"]
SCORE_LINES = ["2-0", "2-1", "3-0", "3-1", "3-2"]
TIERS = ["Supermajor (500+)", "Major (200-499)", "Regional (100-199)"]
THRESHOLDS = [5, 10, 25, 50, 100]


def dataset_summary(tables: dict[str, DataFrame]) -> DataFrame:
    span = tables["sets"].agg(F.timestamp_seconds(F.min("completed_at")).alias("a"), F.timestamp_seconds(F.max("completed_at")).alias("b"))
    return table_stats(tables).crossJoin(F.broadcast(span)).select("table_name", "n", F.date_format("a", "yyyy-MM-dd").alias("first_day"), F.date_format("b", "yyyy-MM-dd").alias("last_day"))  # one row


def per_quarter(df: DataFrame, ts: str) -> DataFrame:
    """Rows per calendar quarter, quarters without rows included."""
    q = df.filter(F.col(ts).isNotNull()).groupBy(F.date_trunc("quarter", F.timestamp_seconds(ts)).alias("q")).agg(F.count(F.lit(1)).alias("n"))
    spine = q.agg(F.min("q").alias("a"), F.max("q").alias("b")).filter("a is not null").select(F.explode(F.expr("sequence(a, b, interval 3 months)")).alias("q"))
    return spine.join(q, "q", "left").select(F.concat(F.year("q"), F.lit(" Q"), F.quarter("q")).alias("quarter"), F.coalesce("n", F.lit(0)).alias("n"))


def histogram(df: DataFrame, col: Column, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal bins from lo to hi (the smallest and largest value where not given); the last one is closed. Zero-filled."""
    x = df.select(col.cast("double").alias("x")).filter("x is not null")
    ends = x.agg((F.min("x") if lo is None else F.lit(float(lo))).alias("lo"), (F.max("x") if hi is None else F.lit(float(hi))).alias("hi")).withColumn("hi", F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("lo") + 1))
    rows = x.crossJoin(F.broadcast(ends)).filter("x >= lo and x <= hi")  # one row
    n = rows.groupBy(F.least(F.floor((F.col("x") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = ends.filter("lo is not null").select("lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    return spine.join(n, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n"))


def tier_counts(t: DataFrame) -> DataFrame:
    n = t.groupBy(tier(F.col("num_attendees")).alias("tier")).agg(F.count(F.lit(1)).alias("n"))
    return _spine(t, TIERS, "tier").join(n, "tier", "left").select("place", "tier", F.coalesce("n", F.lit(0)).alias("n"))


def _spine(like: DataFrame, values: list[str], name: str) -> DataFrame:
    return like.sparkSession.createDataFrame(list(enumerate(values)), f"place int, {name} string")


def median_attendees(t: DataFrame) -> DataFrame:
    from .evaluation import percentiles

    return percentiles(t, "num_attendees", [0.5]).select(F.get("q", F.lit(0)).alias("median_attendees"))


def largest(t: DataFrame, n: int = 10) -> DataFrame:
    return t.orderBy(F.desc("num_attendees"), "id").limit(n).select("id", "name", "num_attendees", F.date_format(F.timestamp_seconds("start_at"), "yyyy-MM-dd").alias("day"))


def _seeded(sets: DataFrame) -> DataFrame:
    rows = decided(sets).filter(F.col("player1_seed").isNotNull() & F.col("player2_seed").isNotNull() & (F.col("player1_seed") != F.col("player2_seed")))
    top = F.when(F.col("player1_seed") < F.col("player2_seed"), F.col("player1_id")).otherwise(F.col("player2_id"))
    return rows.select((F.col("winner_player_id") == top).cast("int").alias("hit"), F.abs(F.col("player1_seed") - F.col("player2_seed")).alias("gap"))


def seed_accuracy(sets: DataFrame) -> DataFrame:
    return _seeded(sets).agg(F.avg("hit").alias("rate"), F.count(F.lit(1)).alias("n"))


def seed_accuracy_by_gap(sets: DataFrame) -> DataFrame:
    return _seeded(sets).groupBy(bucket(F.col("gap"), SEED_GAPS, SEED_GAP_LABELS).alias("gap")).agg(F.avg("hit").alias("rate"), F.count(F.lit(1)).alias("n")).filter("gap is not null")


def sets_per_player(sets: DataFrame) -> DataFrame:
    return sets.select(F.explode(F.array("player1_id", "player2_id")).alias("player_id")).filter("player_id is not null").groupBy("player_id").agg(F.count(F.lit(1)).alias("n"))


def activity_cdf(counts: DataFrame) -> DataFrame:
    """Percentile rank (ties share their mean) for each number of sets: ranks come from the few distinct numbers."""
    per = counts.groupBy("n").agg(F.count(F.lit(1)).alias("players"))
    before = F.coalesce(F.sum("players").over(W.orderBy("n").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("players").over(W.partitionBy())
    return per.select("n", "players", ((before + (F.col("players") + 1) / 2) / total).alias("pct"))


def activity_thresholds(counts: DataFrame) -> DataFrame:
    from .evaluation import percentiles

    middle = percentiles(counts, "n", [0.5]).select(F.get("q", F.lit(0)).alias("median"))
    one = counts.agg(F.count(F.lit(1)).alias("total"), F.avg("n").alias("mean"), *(F.count_if(F.col("n") >= k).alias(f"c{k}") for k in THRESHOLDS)).crossJoin(F.broadcast(middle))  # two single rows
    rows = F.array(*(F.struct(F.lit(k).cast("long").alias("min_sets"), F.col(f"c{k}").alias("players"), ratio(F.col(f"c{k}"), F.col("total")).alias("share"), "median", "mean") for k in THRESHOLDS))
    return one.select(F.inline(rows))


def player_records(sets: DataFrame, players: DataFrame) -> DataFrame:
    rows = decided(sets).select("winner_player_id", F.explode(F.array("player1_id", "player2_id")).alias("player_id"))
    n = rows.groupBy("player_id").agg(F.count_if(F.col("winner_player_id") == F.col("player_id")).alias("wins"), F.count(F.lit(1)).alias("total"))
    n = n.select("player_id", "wins", (F.col("total") - F.col("wins")).alias("losses"), "total", ratio(F.col("wins"), F.col("total")).alias("win_rate"))
    return n.join(players.withColumnRenamed("id", "player_id").select("player_id", "gamer_tag"), "player_id", "left")


def most_active(records: DataFrame, n: int = 25) -> DataFrame:
    return records.orderBy(F.desc("total"), "player_id").limit(n)


def best_records(records: DataFrame, min_sets: int = 100, n: int = 15) -> DataFrame:
    return records.filter(F.col("total") >= min_sets).orderBy(F.desc("win_rate"), "player_id").limit(n)


def pair_records(sets: DataFrame, min_sets: int) -> DataFrame:
    """player_a < player_b with each side's wins, for pairs of at least min_sets decided sets."""
    a, b = F.least("player1_id", "player2_id"), F.greatest("player1_id", "player2_id")
    rows = decided(sets).filter(F.col("player1_id").isNotNull() & F.col("player2_id").isNotNull()).select(a.alias("player_a"), b.alias("player_b"), (F.col("winner_player_id") == a).alias("won"))
    n = rows.groupBy("player_a", "player_b").agg(F.count_if("won").alias("a_wins"), F.count_if(~F.col("won")).alias("b_wins"))
    return n.filter(F.col("a_wins") + F.col("b_wins") >= min_sets)


def rivalries(sets: DataFrame, players: DataFrame, top: DataFrame, min_sets: int = 3, n: int = 30) -> DataFrame:
    """Pairs within the player ids of `top`, most sets first, with tags (the id without one)."""
    ids = top.select("player_id")
    mine = sets.join(ids.withColumnRenamed("player_id", "player1_id"), "player1_id", "left_semi").join(ids.withColumnRenamed("player_id", "player2_id"), "player2_id", "left_semi")
    best = pair_records(mine, min_sets).withColumn("total", F.col("a_wins") + F.col("b_wins")).orderBy(F.desc("total"), "player_a", "player_b").limit(n)
    for side in "ab":
        tag = players.select(F.col("id").alias(f"player_{side}"), F.col("gamer_tag").alias(f"tag_{side}"))
        best = best.join(tag, f"player_{side}", "left").withColumn(f"tag_{side}", F.coalesce(f"tag_{side}", F.col(f"player_{side}").cast("string")))
    return best.select("player_a", "player_b", "tag_a", "tag_b", "a_wins", "b_wins", "total")


def coverage_by_quarter(sets: DataFrame, games: DataFrame) -> DataFrame:
    """Percent of each quarter's sets that have game data."""
    some = sets.join(games.select(F.col("set_id").alias("id")), "id", "left_semi")
    a, b = per_quarter(sets, "completed_at"), per_quarter(some, "completed_at").withColumnRenamed("n", "m")
    return a.join(b, "quarter", "left").select("quarter", (100 * ratio(F.coalesce("m", F.lit(0)), F.col("n"))).alias("coverage"))


def top_characters(games: DataFrame, n: int = 15) -> DataFrame:
    c = games.select(F.explode(F.array("player1_character_name", "player2_character_name")).alias("character")).filter("character is not null")
    return c.groupBy("character").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "character").limit(n)


def coverage_totals(sets: DataFrame, games: DataFrame) -> DataFrame:
    s = sets.agg(F.count(F.lit(1)).alias("sets"))
    g = games.agg(F.count_distinct("set_id").alias("sets_with_games"), F.count(F.lit(1)).alias("games"), F.count("player1_character_name").alias("games_with_character"))
    rows = s.crossJoin(F.broadcast(g))  # two single rows
    return rows.select("*", ratio(F.col("sets_with_games"), F.col("sets")).alias("set_share"), ratio(F.col("games_with_character"), F.col("games")).alias("game_share"))


def _lines(sets: DataFrame) -> DataFrame:
    hi, lo = F.greatest("player1_score", "player2_score"), F.least("player1_score", "player2_score")
    rows = sets.filter(F.col("player1_score").isNotNull() & F.col("player2_score").isNotNull())
    return rows.select(F.concat_ws("-", hi.cast("int"), lo.cast("int")).alias("line"))


def score_lines(sets: DataFrame) -> DataFrame:
    n = _lines(sets).filter(F.col("line").isin(SCORE_LINES)).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    return _spine(sets, SCORE_LINES, "line").join(n, "line", "left").select("place", "line", F.coalesce("n", F.lit(0)).alias("n"))


def format_share(sets: DataFrame) -> DataFrame:
    """Best-of-three and best-of-five sets: number, share, and how many end without a lost game."""
    c = lambda *lines: F.count_if(F.col("line").isin(*lines))
    one = _lines(sets).filter(F.col("line").isin(SCORE_LINES)).agg(c("2-0", "2-1").alias("n3"), c("3-0", "3-1", "3-2").alias("n5"), c("2-0").alias("s3"), c("3-0").alias("s5"))
    row = lambda name, n, s: F.struct(F.lit(name).alias("format"), F.col(n).alias("n"), ratio(F.col(n), F.col("n3") + F.col("n5")).alias("share"), ratio(F.col(s), F.col(n)).alias("sweep_rate"))
    return one.select(F.inline(F.array(row("Bo3", "n3", "s3"), row("Bo5", "n5", "s5"))))
