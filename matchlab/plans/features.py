"""The feature table: completed sets, ratings and histories joined on the set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.elo import elo_ratings, elo_ratings_bounded, end_state
from ..operators.history import completed_sets, history_features, long_form, pair_state, player_state
from ..operators.evaluation import active_rows
from ..operators.quality import assert_valid, check_schema, feature_rules
from ..sources.schemas import FEATURES
from ..sources.stored import read_versioned, write_versioned
from ..sources.tables import load_tables, staged, write_table


#: Sets of a time segment: beyond them, histories are computed by segments, and ratings by slices of twice as many.
MOST = 500_000


def feature_columns(rows: DataFrame, rated: DataFrame) -> DataFrame:
    """The 27 columns from history_features' rows and their ratings."""
    rated = rated.select("set_id", "p1_elo", "p2_elo", (F.col("p1_elo") - F.col("p2_elo")).alias("elo_diff"), "p1_expected")
    return rows.join(rated, "set_id").select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURES.fields))


def build_features(tables: dict[str, DataFrame], pool: str | None = None, most: int = MOST) -> DataFrame:
    """27 ordered columns, one row per decided set, nothing in them from the set itself or later but its outcome."""
    done = staged(completed_sets(tables["sets"], tables["events"], tables["tournaments"]), "completed")  # read by ratings and histories
    rated = elo_ratings(done, pool) if pool else elo_ratings_bounded(done, 2 * most)
    return feature_columns(history_features(done, most=most), rated)


def rated_sets(tables: dict[str, DataFrame], most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """The completed sets and their ratings, for what needs no histories."""
    done = staged(completed_sets(tables["sets"], tables["events"], tables["tournaments"]), "completed")
    return done, elo_ratings_bounded(done, 2 * most)


def rating_predictions(tables: dict[str, DataFrame], most: int = MOST) -> DataFrame:
    """Each decided set with the chance that its ratings gave (prob) and its outcome, as build_features' rows have them."""
    done, rated = rated_sets(tables, most)
    won = (F.col("winner_player_id") == F.col("player1_id")).cast("int").alias("p1_won")
    rows = done.select("set_id", "tournament_name", "player1_id", "player2_id", won)
    return staged(rows.join(rated.select("set_id", F.col("p1_expected").alias("prob")), "set_id"), "predictions")


def continued_features(tables: dict[str, DataFrame], path: str, most: int = MOST) -> DataFrame:
    """Features of a later batch of sets, going on from the state below `path` (none yet: from the start), and the state
    after the batch stored there: per player the rating, the number of sets and the last 30 results, per pair the
    record. The batch's sets must be later than all sets before. The new state is written whole before the marker that
    names it, so a run that fails leaves the former one."""
    spark = next(iter(tables.values())).sparkSession
    done = staged(completed_sets(tables["sets"], tables["events"], tables["tournaments"]), "batch")
    state = read_state(spark, path)
    players, pairs = state if state else (None, None)
    rated = staged(elo_ratings_bounded(done, 2 * most, None if players is None else players.select("player_id", "rating", F.col("sets_played").alias("played"))), "batch-rated")
    rows = staged(feature_columns(history_features(done, most=most, players=players, pairs=pairs), rated), "batch-features")
    now = player_state(long_form(done), state=players).join(end_state(done, rated, None if players is None else players.select("player_id", "rating", F.col("sets_played").alias("played"))).select("player_id", "rating"), "player_id")
    write_versioned({"players": now, "pairs": pair_state(done, pairs)}, path)
    return rows


def read_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    found = read_versioned(spark, path, ["players", "pairs"])
    return (found["players"], found["pairs"]) if found else None


def read_features(spark: SparkSession, path: str, min_sets: int = 0) -> DataFrame:
    """The stored feature table, of rows whose players both have min_sets earlier sets; a file whose columns, order or
    types differ from the declared ones is refused."""
    rows = spark.read.parquet(path)
    if differing := check_schema(rows, FEATURES):
        raise ValueError("; ".join(differing))
    return active_rows(rows, min_sets) if min_sets else rows


def build_and_export(spark: SparkSession, source: str, target: str, pool: str | None = None) -> DataFrame:
    """Build from the tables below source, check the rules, write Parquet to target and read it back."""
    write_table(build_features(load_tables(spark, source), pool), target)
    rows = read_features(spark, target)
    assert_valid(rows, feature_rules())
    return rows
