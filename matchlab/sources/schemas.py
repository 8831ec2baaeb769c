"""Declared schemas. Column names, order and types of these tables are fixed values."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

_TYPES = {"long": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType(), "boolean": BooleanType()}


def _struct(ddl: str) -> StructType:
    """A flat schema from "name type [not null], ..."; needs no session."""
    parts = [x.split() for x in ddl.split(", ")]
    return StructType([StructField(p[0], _TYPES[p[1]], len(p) == 2) for p in parts])


TABLES = {
    "tournaments": _struct("id long not null, name string not null, slug string, num_attendees long, start_at long, end_at long, city string, state string, country_code string, is_online boolean"),
    "events": _struct("id long not null, tournament_id long not null, name string not null, slug string, num_entrants long"),
    "players": _struct("id long not null, gamer_tag string not null"),
    "sets": _struct("id long not null, event_id long not null, round int, full_round_text string, phase_name string, completed_at long, total_games int, display_score string, entrant1_id long, entrant2_id long, player1_id long, player2_id long, winner_player_id long, player1_score double, player2_score double, player1_seed long, player2_seed long, state int"),
    "games": _struct("id long not null, set_id long not null, game_number int not null, winner_entrant_id long, stage_id long, stage_name string, player1_character_id long, player1_character_name string, player2_character_id long, player2_character_name string"),
}

#: Columns of a table that keep their first value on an upsert.
KEEP_FIRST = {"tournaments": [], "events": ["tournament_id"], "players": [], "sets": ["event_id"], "games": ["set_id"]}
UNIQUE = {"tournaments": ["slug"], "events": ["slug"]}
FOREIGN = [("events", "tournament_id", "tournaments"), ("sets", "event_id", "events"), ("sets", "player1_id", "players"), ("sets", "player2_id", "players"), ("sets", "winner_player_id", "players"), ("games", "set_id", "sets")]

FEATURES = _struct(
    "set_id long, event_id long, tournament_id long, tournament_name string, completed_at long, player1_id long, player2_id long, p1_elo double, p2_elo double, elo_diff double, p1_expected double, "
    "p1_sets_played long, p2_sets_played long, p1_recent_wr double, p2_recent_wr double, recent_wr_diff double, p1_h2h_wins long, p2_h2h_wins long, p1_h2h_wr double, h2h_total long, p1_seed long, p2_seed long, "
    "seed_diff long, num_attendees long, p1_score double, p2_score double, p1_won int"
)

_ENTRANT = "entrant:struct<id:bigint,name:string,initialSeedNum:bigint,participants:array<struct<player:struct<id:bigint,gamerTag:string>>>>"
#: Nested schemas stay text, which Spark's readers take.
SET_NODE = (
    "id long, displayScore string, winnerId long, round int, fullRoundText string, completedAt long, totalGames int, state int, "
    "games array<struct<id:bigint,orderNum:int,winnerId:bigint,stage:struct<id:bigint,name:string>,selections:array<struct<entrant:struct<id:bigint>,character:struct<id:bigint,name:string>>>>>, "
    f"slots array<struct<seed:struct<seedNum:bigint>,standing:struct<placement:int,stats:struct<score:struct<value:double>>>,{_ENTRANT}>>, "
    "phaseGroup struct<phase:struct<name:string>>, eventId long"
)
TOURNAMENT_NODE = (
    "id long, name string, slug string, numAttendees long, startAt long, endAt long, city string, addrState string, countryCode string, isOnline boolean, "
    "events array<struct<id:bigint,name:string,slug:string,numEntrants:bigint,videogame:struct<id:bigint>>>"
)
NODES = {"sets": SET_NODE, "tournaments": TOURNAMENT_NODE}
