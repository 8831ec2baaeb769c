"""Match tables m_* derived from the events and customer tables: a pair of neighbouring events is a match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_VIEWS = {
    "m_base": """
select x.*, cast(floor((x.completed_at - 1704067200) / 86400) as bigint) + 1 as tournament_id,
  (cast(floor((x.completed_at - 1704067200) / 86400) as bigint) + 1) * 10
    + case x.et1 when 'click' then 1 when 'error' then 2 when 'purchase' then 3 when 'signup' then 4 else 5 end as event_id
from (select cast(floor(a.event_id / 2) as bigint) as id, {EPOCH} as completed_at, a.event_type as et1, b.event_type as et2,
        a.user_id as p1, b.user_id as p2,
        case when a.value > b.value then a.user_id when b.value > a.value then b.user_id end as w,
        cast(regexp_extract(a.props, '([0-9]+)', 1) as int) as k
      from {EVENTS} a join {EVENTS} b on b.event_id = a.event_id + 1
      where a.event_id % 2 = 0 and a.user_id <> b.user_id) x""",
    "m_sets": """
select id, event_id, 1 as round, case when k >= 90 then 'Grand Final' else 'Winners Round 1' end as full_round_text,
  case when k >= 50 then 'Bracket' else 'Pools' end as phase_name, completed_at, need + lost as total_games,
  p1 as player1_id, p2 as player2_id, w as winner_player_id,
  cast(case when k = 50 or w is null then null when w = p1 then need else lost end as double) as player1_score,
  cast(case when k = 50 or w is null then null when w = p2 then need else lost end as double) as player2_score,
  1 + (p1 * 31 + tournament_id * 17) % 64 as player1_seed, 1 + (p2 * 31 + tournament_id * 17) % 64 as player2_seed, 3 as state
from (select z.*, cast(floor(z.k / 2) as int) % z.need as lost
      from (select m_base.*, case when k % 2 = 0 then 2 else 3 end as need from m_base) z) y""",
    "m_tournaments": """
select tournament_id as id, concat('Open #', cast(tournament_id as varchar(10))) as name, 100 + (tournament_id * 37) % 600 as num_attendees,
  min(completed_at) as start_at, max(completed_at) as end_at, (tournament_id % 10 = 0) as is_online
from m_base group by tournament_id""",
    "m_events": """
select event_id as id, tournament_id, concat('Singles ', min(et1)) as name, count(distinct p1) as num_entrants
from m_base group by event_id, tournament_id""",
    "m_players": "select c_custkey as id, c_name as gamer_tag from {CUSTOMER}",
    "m_games": """
select s.id * 10 + g.n as id, s.id as set_id, g.n as game_number,
  case when s.k = 3 then null else s.et1 end as player1_character_name, case when s.k = 3 then null else s.et2 end as player2_character_name
from (select b.*, t.total_games from m_base b join m_sets t on t.id = b.id) s
cross join (values (1), (2), (3), (4), (5)) as g(n)
where s.k < 8 and g.n <= s.total_games""",
}
NAMES = list(_VIEWS)

#: The views as common table expressions, for queries in DuckDB.
CTES = ",\n".join(f"{k} as ({v.format(EPOCH="cast(epoch(date_trunc('second', a.ts)) as bigint)", EVENTS='events', CUSTOMER='customer')})" for k, v in _VIEWS.items())


def match_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """base, sets, tournaments, events, players and games, lazily read."""
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("m_raw_events")
    spark.read.parquet(f"{sf_dir}/customer.parquet").createOrReplaceTempView("m_raw_customer")
    return _views(spark, {})


def over_base(base: DataFrame) -> dict[str, DataFrame]:
    """The last match_tables again, over their base as given: sets, events and tournaments each read it."""
    return _views(base.sparkSession, {"m_base": base})


def _views(spark: SparkSession, given: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    for name, sql in _VIEWS.items():
        df = given[name] if name in given else spark.sql(sql.format(EPOCH="unix_timestamp(cast(a.ts as timestamp))", EVENTS="m_raw_events", CUSTOMER="m_raw_customer"))
        df.createOrReplaceTempView(name)
        out[name.removeprefix("m_")] = df
    return out
