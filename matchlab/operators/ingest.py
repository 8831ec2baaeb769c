"""From raw nested nodes to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import staged, upsert, upsert_table


def time_chunks(spark: SparkSession, after: int, before: int, days: int = 90) -> DataFrame:
    """Windows [start, stop) of `days` days from after to before; the last one is clipped."""
    step = days * 86_400
    if before <= after:
        return spark.createDataFrame([], "start long, stop long")
    starts = spark.range(after, before, step).withColumnRenamed("id", "start")
    return starts.select("start", F.least(F.col("start") + step, F.lit(before)).alias("stop"))


def table_chunks(df: DataFrame, ts: str, days: int = 90) -> DataFrame:
    """time_chunks over the span of a table's column, its latest value included. No rows give no chunk."""
    step = days * 86_400
    ends = df.agg(F.min(ts).alias("a"), (F.max(ts) + 1).alias("b")).filter("a is not null")
    starts = ends.select("b", F.explode(F.expr(f"sequence(a, b - 1, {step}L)")).alias("start"))
    return starts.select("start", F.least(F.col("start") + step, F.col("b")).alias("stop"))


def merge_first(chunks: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the order of the chunks; summed before the shuffle, so a hot key is no hot task."""
    rest = [c for c in chunks.columns if c != key]
    return chunks.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*").select(*chunks.columns)


def eligible_tournaments(df: DataFrame, min_attendees: int = 50) -> DataFrame:
    return df.filter((F.coalesce("numAttendees", F.lit(0)) >= min_attendees) & ~F.coalesce("isOnline", F.lit(False)))


def explode_events(tournaments: DataFrame, game_id: int = 1) -> DataFrame:
    e = tournaments.select(F.col("id").alias("tournament_id"), F.explode("events").alias("e")).filter(F.col("e.videogame.id") == game_id)
    return e.select(F.col("e.id").alias("id"), "tournament_id", F.col("e.name").alias("name"), F.col("e.slug").alias("slug"), F.col("e.numEntrants").alias("num_entrants"))


def new_events(events: DataFrame, sets: DataFrame) -> DataFrame:
    return events.join(sets.select(F.col("event_id").alias("id")).distinct(), "id", "left_anti")


def parse_slots(nodes: DataFrame) -> DataFrame:
    """Adds s1 and s2: entrant, player and tag of the first participant, seed (0 counts as missing), score, placement."""

    def slot(i: int):
        s = F.get(F.col("slots"), F.lit(i))
        who = F.get(s["entrant"]["participants"], F.lit(0))["player"]
        return F.struct(
            s["entrant"]["id"].alias("entrant"), who["id"].alias("player"), who["gamerTag"].alias("tag"), F.coalesce(F.nullif(s["seed"]["seedNum"], F.lit(0)), s["entrant"]["initialSeedNum"]).alias("seed"),
            s["standing"]["stats"]["score"]["value"].alias("score"), s["standing"]["placement"].alias("placement"),
        )

    return nodes.withColumn("s1", slot(0)).withColumn("s2", slot(1))


def valid_sets(nodes: DataFrame) -> DataFrame:
    """Finished sets with two known players."""
    rows = nodes if "s1" in nodes.columns else parse_slots(nodes)
    return rows.filter((F.size("slots") >= 2) & (F.col("s1.player") != 0) & (F.col("s2.player") != 0) & (F.col("state") == 3))


def parse_sets(nodes: DataFrame) -> DataFrame:
    winner = F.when(F.col("winnerId").eqNullSafe(F.col("s1.entrant")), F.col("s1.player")).when(F.col("winnerId").eqNullSafe(F.col("s2.entrant")), F.col("s2.player"))
    return valid_sets(nodes).select(
        "id", F.col("eventId").alias("event_id"), "round", F.col("fullRoundText").alias("full_round_text"), F.col("phaseGroup.phase.name").alias("phase_name"), F.col("completedAt").alias("completed_at"),
        F.col("totalGames").alias("total_games"), F.col("displayScore").alias("display_score"), F.col("s1.entrant").alias("entrant1_id"), F.col("s2.entrant").alias("entrant2_id"),
        F.col("s1.player").alias("player1_id"), F.col("s2.player").alias("player2_id"), winner.alias("winner_player_id"), F.col("s1.score").alias("player1_score"), F.col("s2.score").alias("player2_score"),
        F.col("s1.seed").alias("player1_seed"), F.col("s2.seed").alias("player2_seed"), "state",
    )


def parse_games(nodes: DataFrame) -> DataFrame:
    """Games of valid sets. A selection of slot 1's entrant is never slot 2's; of several, the last one counts."""
    g = valid_sets(nodes).select(F.col("id").alias("set_id"), F.col("s1.entrant").alias("e1"), F.col("s2.entrant").alias("e2"), F.explode("games").alias("g")).filter(F.col("g.id").isNotNull() & (F.col("g.id") != 0))
    picks = F.coalesce(F.col("g.selections"), F.array())
    c1 = F.try_element_at(F.filter(picks, lambda x: x["entrant"]["id"].eqNullSafe(F.col("e1"))), F.lit(-1))["character"]
    c2 = F.try_element_at(F.filter(picks, lambda x: x["entrant"]["id"].eqNullSafe(F.col("e2")) & ~x["entrant"]["id"].eqNullSafe(F.col("e1"))), F.lit(-1))["character"]
    return g.select(
        F.col("g.id").alias("id"), "set_id", F.col("g.orderNum").alias("game_number"), F.col("g.winnerId").alias("winner_entrant_id"), F.col("g.stage.id").alias("stage_id"), F.col("g.stage.name").alias("stage_name"),
        c1["id"].alias("player1_character_id"), c1["name"].alias("player1_character_name"), c2["id"].alias("player2_character_id"), c2["name"].alias("player2_character_name"),
    )


def parse_players(nodes: DataFrame) -> DataFrame:
    """All participants of valid sets with an id and a tag; the tag of the latest set (then slot, place) stays."""
    rows = valid_sets(nodes).select(F.col("completedAt").alias("at"), F.col("id").alias("set_id"), F.posexplode("slots").alias("slot", "s"))
    rows = rows.select("at", "set_id", "slot", F.posexplode("s.entrant.participants").alias("place", "p")).select(F.col("p.player.id").alias("id"), F.col("p.player.gamerTag").alias("gamer_tag"), "at", "set_id", "slot", "place")
    rows = rows.filter((F.col("id") != 0) & (F.col("gamer_tag") != ""))
    return upsert(None, rows, ["id"], ["at", "set_id", "slot", "place"]).select("id", "gamer_tag")


def tournaments_table(nodes: DataFrame) -> DataFrame:
    return nodes.select("id", "name", "slug", F.col("numAttendees").alias("num_attendees"), F.col("startAt").alias("start_at"), F.col("endAt").alias("end_at"), "city", F.col("addrState").alias("state"), F.col("countryCode").alias("country_code"), F.col("isOnline").alias("is_online"))


def broken_tournaments(nodes: DataFrame, events: DataFrame, sets: DataFrame) -> DataFrame:
    """(tournament_id, reason): tournaments of which some node lacks what its table requires. nodes: eligible tournament
    nodes; events: their exploded events; sets: parsed set nodes with tournament_id."""
    found = [nodes.filter(F.col("name").isNull()).select(F.col("id").alias("tournament_id"), F.lit("tournament without a name").alias("reason"))]
    for missing in ("id", "name"):
        found.append(events.filter(F.col(missing).isNull()).select("tournament_id", F.lit(f"event without {'an id' if missing == 'id' else 'a name'}")))
    valid = valid_sets(sets)
    found.append(valid.filter(F.col("id").isNull()).select("tournament_id", F.lit("set without an id")))
    games = valid.select("tournament_id", F.explode("games").alias("g")).filter(F.col("g.id").isNotNull() & (F.col("g.id") != 0))
    found.append(games.filter(F.col("g.orderNum").isNull()).select("tournament_id", F.lit("game without a number")))
    out = found[0]
    for df in found[1:]:
        out = out.union(df)
    return out.distinct()


def ingest(raw_tournaments: DataFrame, raw_sets: DataFrame, target: dict[str, DataFrame] | None = None, min_attendees: int = 50, game_id: int = 1) -> dict[str, DataFrame]:
    """The five tables after the batch, and _rejects (kind, tournament_id, reason, line): raw lines that did not parse, and
    tournaments left out whole because one of their nodes breaks a rule; the others go through. Events already stored
    are skipped. Tournament nodes, set nodes and broken tournaments are stored once; the tables read them."""
    target = target or {}
    ok = raw_tournaments.filter("_corrupt is null") if "_corrupt" in raw_tournaments.columns else raw_tournaments
    nodes = staged(eligible_tournaments(ok, min_attendees), "ingest-tournaments")  # nodes are parsed once for all tables
    events = explode_events(nodes, game_id)
    if "sets" in target:
        events = events.filter("id is null").unionByName(new_events(events.filter("id is not null"), target["sets"]))
    good = raw_sets.filter("_corrupt is null") if "_corrupt" in raw_sets.columns else raw_sets
    mine = staged(parse_slots(good.join(events.select(F.col("id").alias("eventId"), "tournament_id").dropDuplicates(["eventId"]), "eventId")), "ingest-sets")
    broken = staged(broken_tournaments(nodes, events, mine), "ingest-broken")
    lost = broken.select("tournament_id").distinct()
    nodes = nodes.join(lost.withColumnRenamed("tournament_id", "id"), "id", "left_anti")
    events, mine = events.join(lost, "tournament_id", "left_anti"), mine.join(lost, "tournament_id", "left_anti")
    events = events.select("id", "tournament_id", "name", "slug", "num_entrants")
    batch = {"tournaments": tournaments_table(nodes), "events": events, "players": parse_players(mine), "sets": parse_sets(mine), "games": parse_games(mine)}
    version = {"tournaments": ["end_at"], "events": ["num_entrants"], "players": ["gamer_tag"], "sets": ["completed_at"], "games": ["game_number"]}
    out = {name: upsert_table(name, target.get(name), df, version[name]) for name, df in batch.items()}
    rejects = broken.select(F.lit("tournament").alias("kind"), "tournament_id", "reason", F.lit(None).cast("string").alias("line"))
    for kind, df in (("tournaments", raw_tournaments), ("sets", raw_sets)):
        if "_corrupt" in df.columns:
            rejects = rejects.unionByName(df.filter("_corrupt is not null").select(F.lit(kind).alias("kind"), F.lit(None).cast("long").alias("tournament_id"), F.lit("line that does not parse").alias("reason"), F.col("_corrupt").alias("line")))
    return out | {"_rejects": rejects}
