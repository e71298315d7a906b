"""Staging models and marts over RAW tables derived from the given tables.

The SQL twins do not read JSON: they compute each column from the table the payload came from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchflow import plans
from pitchflow.bindings import derived
from pitchflow.bindings.registry import query
from pitchflow.functions import array_size, number, try_jget

AT = "TIMESTAMP '2025-01-01 00:00:00' + to_seconds({0})"


def _num(column: str, path: str, name: str):
    return number(F.col(column), path).alias(name)


@query(
    "stg_league",
    f"""
    SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN {AT.format("c_custkey")} END AS ingested_at,
           c_custkey // 3 AS league_id, CAST(2020 + c_custkey % 3 AS INTEGER) AS season,
           CASE WHEN ok THEN c_custkey // 3 END AS league_id_from_payload,
           CASE WHEN ok THEN ' League ' || c_nationkey || ' ' END AS league_name,
           CASE WHEN ok THEN c_mktsegment END AS league_type,
           CASE WHEN ok THEN 'https://img/' || c_custkey END AS league_logo,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' WHEN ok THEN 'NATION_' || c_nationkey END AS country_name,
           CASE WHEN ok THEN CASE WHEN c_acctbal >= 0 THEN 'N' || chr(65 + c_nationkey) ELSE 'n1' END END AS country_code,
           CASE WHEN ok THEN 'https://flag/' || c_nationkey END AS country_flag
    FROM (SELECT *, c_mktsegment <> 'AUTOMOBILE' AS ok FROM customer)
    """,
)
def stg_league(t):
    return plans.stg_league(derived.raw_league(t.customer)).drop("payload")


@query(
    "stg_teams_info",
    f"""
    SELECT {AT.format("s_suppkey")} AS ingested_at, CAST(s_nationkey AS BIGINT) AS league_id, 2025 AS season,
           s_suppkey AS team_id, s_suppkey AS api_team_id,
           CASE WHEN s_acctbal < 0 THEN '   ' ELSE ' ' || s_name END AS team_name,
           'S' || s_nationkey AS team_code, 'NATION_' || s_nationkey AS team_country,
           CAST(1900 + s_nationkey AS BIGINT) AS team_founded, s_acctbal > 5000 AS is_national_team,
           'https://img/' || s_suppkey AS team_logo_url, s_suppkey + 1000 AS venue_id,
           'Park ' || s_suppkey AS venue_name, s_suppkey || ' St' AS venue_address,
           'City ' || s_nationkey AS venue_city, 20000 + s_suppkey AS venue_capacity, 'grass' AS venue_surface,
           'https://venue/' || s_suppkey AS venue_image_url
    FROM supplier
    """,
)
def stg_teams_info(t):
    return plans.stg_teams_info(derived.raw_teams_info(t.supplier)).drop("payload_json")


@query(
    "stg_team_statistics",
    f"""
    SELECT {AT.format("c_custkey")} AS ingested_at, CAST(c_nationkey AS BIGINT) AS league_id, 2024 AS season,
           c_custkey AS team_id, c_name AS team_name, 'https://img/' || c_custkey AS team_logo_url,
           CASE WHEN c_acctbal >= 0 THEN 'WDL' END AS form,
           CAST(38 AS BIGINT) AS fixtures_played_total, CAST(c_nationkey AS BIGINT) AS fixtures_wins_total,
           CAST(38 - c_nationkey AS BIGINT) AS fixtures_draws_total, CAST(NULL AS BIGINT) AS fixtures_loses_total,
           c_custkey AS goals_for_total, CAST(c_nationkey + 1 AS BIGINT) AS goals_against_total,
           CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38, 0)) AS BIGINT) AS goals_for_avg_total,
           CAST(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS BIGINT) AS goals_against_avg_total,
           CAST(c_nationkey AS BIGINT) AS clean_sheet_total, CAST(1 AS BIGINT) AS failed_to_score_total,
           CAST(2 AS BIGINT) AS penalty_scored_total, CAST(c_nationkey AS BIGINT) AS penalty_missed_total
    FROM customer
    """,
)
def stg_team_statistics(t):
    return plans.stg_team_statistics(derived.raw_teams_statistics(t.customer)).drop("payload_json")


@query(
    "stg_players_statistics",
    f"""
    SELECT {AT.format("p_partkey")} AS ingested_at, CAST(p_size AS BIGINT) AS league_id, 2025 AS season,
           CAST(CASE WHEN p_type <> 'ECONOMY' THEN p_size END AS BIGINT) AS team_id, p_partkey AS player_id,
           split_part(p_name, ' ', 1) AS player_first_name,
           CASE WHEN p_type <> 'SMALL' THEN split_part(p_name, ' ', 2) END AS player_last_name,
           CAST(p_size AS BIGINT) AS player_age, p_brand AS player_nationality,
           CASE WHEN p_size > 40 THEN 'http:' ELSE 'https:' END || '//photo/' || p_partkey AS player_photo_url,
           CASE WHEN p_type <> 'ECONOMY' THEN p_partkey END AS games_minutes,
           CAST(CASE WHEN p_type <> 'ECONOMY' THEN p_size END AS BIGINT) AS goals_total,
           p_type <> 'ECONOMY' AS has_passes, false AS has_cards
    FROM part
    """,
)
def stg_players_statistics(t):
    staged = plans.stg_players_statistics(derived.raw_players_statistics(t.part))
    plain = [c for c in staged.columns if not c.endswith("_json")]
    return staged.select(
        *plain,
        _num("games_json", "$.minutes", "games_minutes"),
        _num("goals_json", "$.total", "goals_total"),
        F.col("passes_json").isNotNull().alias("has_passes"),
        F.col("cards_json").isNotNull().alias("has_cards"),
    )


@query(
    "stg_player_trophies",
    """
    WITH lists AS (SELECT p_partkey // 2 AS player_id, * FROM part),
    trophies AS (
      SELECT *, p_brand || '-' || i AS league, CAST(2000 + i AS VARCHAR) AS season,
             CASE WHEN i = p_size THEN 'Winner' ELSE '2nd Place' END AS place
      FROM (SELECT *, unnest(range(1, p_size + 1)) AS i FROM lists)),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY i, p_partkey) AS rn FROM trophies
      QUALIFY rn <= 20),
    longest AS (
      SELECT player_id, p_size AS payload_trophies FROM lists
      QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY p_brand || '-' DESC, p_size) = 1)
    SELECT r.player_id, CAST(max(p_size) AS BIGINT) AS league_id,
           max(CASE WHEN rn = 1 THEN league END) AS trophy_1_league,
           max(CASE WHEN rn = 1 THEN season END) AS trophy_1_season,
           max(CASE WHEN rn = 1 THEN place END) AS trophy_1_place,
           max(CASE WHEN rn = 2 THEN league END) AS trophy_2_league,
           max(CASE WHEN rn = 2 THEN season END) AS trophy_2_season,
           max(CASE WHEN rn = 2 THEN place END) AS trophy_2_place,
           max(CASE WHEN rn = 3 THEN league END) AS trophy_3_league,
           max(CASE WHEN rn = 3 THEN season END) AS trophy_3_season,
           max(CASE WHEN rn = 3 THEN place END) AS trophy_3_place,
           r.player_id AS payload_id, CAST(max(payload_trophies) AS BIGINT) AS payload_trophies
    FROM ranked r JOIN longest l ON r.player_id = l.player_id GROUP BY r.player_id
    """,
)
def stg_player_trophies(t):
    staged = plans.stg_player_trophies(derived.raw_player_trophies(t.part))
    payload = F.col("payload_json")
    return staged.select(
        *[c for c in staged.columns if c != "payload_json"],
        number(payload, "$.id").alias("payload_id"),
        array_size(payload, "$.trophies").alias("payload_trophies"),
    )


FIXTURES = f"""
    SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN {AT.format("o_orderkey")} END AS ingested_at,
           o_custkey // 100 AS league_id, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderkey // 2 AS fixture_id,
           o_orderkey AS api_fixture_id, o_orderdate + INTERVAL 14 HOURS AS fixture_date_utc,
           o_orderkey * 10 AS fixture_timestamp, 'UTC' AS fixture_timezone, CAST(NULL AS VARCHAR) AS referee,
           o_orderkey AS period_first_ts, o_orderkey + 2700 AS period_second_ts,
           CAST(CASE o_orderstatus WHEN 'F' THEN 90 WHEN 'P' THEN 45 END AS BIGINT) AS status_elapsed,
           CAST(NULL AS BIGINT) AS status_extra,
           CASE o_orderstatus WHEN 'F' THEN 'Match Finished' WHEN 'P' THEN 'First Half' ELSE 'Not Started' END AS status_long,
           CASE o_orderstatus WHEN 'F' THEN 'FT' WHEN 'P' THEN '1H' ELSE 'NS' END AS status_short,
           o_custkey AS venue_id, 'Park ' || o_custkey AS venue_name, 'Town' AS venue_city,
           o_orderkey // 100 AS goals_home, CAST(2 AS BIGINT) AS goals_away, o_custkey // 100 AS api_league_id,
           'Alpha' AS league_name, 'X' AS league_country, CAST(year(o_orderdate) AS BIGINT) AS league_season,
           o_orderpriority AS league_round, o_orderstatus = 'F' AS league_standings, 'u' AS league_logo_url,
           'f' AS league_flag_url, o_custkey AS home_team_id, 'Team ' || o_custkey AS home_team_name,
           'h' AS home_team_logo_url, o_totalprice > 200000 AS home_team_winner,
           CASE WHEN o_orderstatus <> 'O' THEN o_custkey + 7 END AS away_team_id,
           ' Team ' || (o_custkey + 7) || ' ' AS away_team_name, 'a' AS away_team_logo_url,
           o_totalprice <= 200000 AS away_team_winner,
           CAST(1 AS BIGINT) AS score_ht_home, CAST(0 AS BIGINT) AS score_ht_away,
           CAST(2 AS BIGINT) AS score_ft_home, CAST(1 AS BIGINT) AS score_ft_away,
           CAST(NULL AS BIGINT) AS score_et_home, CAST(NULL AS BIGINT) AS score_et_away,
           CAST(3 AS BIGINT) AS score_p_home, CAST(NULL AS BIGINT) AS score_p_away
    FROM orders WHERE NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P')
"""


@query("stg_fixture_info", FIXTURES)
def stg_fixture_info(t):
    staged = plans.stg_fixture_info(derived.raw_fixture_info(t.orders)).drop("payload_response")
    return staged.withColumn("fixture_date_utc", F.col("fixture_date_utc").cast("timestamp_ntz"))


@query(
    "stg_fixture_line_up",
    f"""
    SELECT {AT.format("o_orderkey")} AS ingested_at, o_custkey // 100 AS league_id,
           CAST(year(o_orderdate) AS INTEGER) AS season, o_orderkey AS fixture_id, o_custkey AS team_id,
           'Team ' || o_custkey AS team_name, 'l' AS team_logo_url, 'red' AS home_color, o_custkey + 1 AS coach_id,
           'Coach ' || o_custkey AS coach_name, 'c' AS coach_photo_url,
           CASE WHEN o_orderpriority <> '2-HIGH' THEN '4-3-3' END AS formation,
           CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 11 END AS BIGINT) AS start_xi_cnt,
           CAST(CASE o_orderstatus WHEN 'F' THEN 7 WHEN 'O' THEN 0 END AS BIGINT) AS substitutes_cnt
    FROM orders
    """,
)
def stg_fixture_line_up(t):
    staged = plans.stg_fixture_line_up(derived.raw_fixture_line_up(t.orders))
    color = try_jget(F.col("team_colors"), "$.home", "string").alias("home_color")
    return staged.select("*", color).drop("team_colors", "start_xi_json", "substitutes_json")


@query(
    "stg_fixture_statistics",
    f"""
    SELECT {AT.format("o_orderkey")} AS ingested_at, o_custkey // 100 AS league_id,
           CAST(year(o_orderdate) AS INTEGER) AS season, o_orderkey AS fixture_id, o_custkey AS team_id,
           'Team ' || o_custkey AS team_name, 'l' AS team_logo_url,
           greatest(o_orderkey, 3) AS shots_on_goal,
           CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38, 0)) AS BIGINT) AS shots_off_goal,
           CAST(NULL AS BIGINT) AS total_shots, CAST(45 AS BIGINT) AS blocked_shots,
           CAST(100 AS BIGINT) AS shots_inside_box, CAST(-3 AS BIGINT) AS shots_outside_box,
           CAST(NULL AS BIGINT) AS fouls, o_custkey AS corner_kicks, CAST(4 AS BIGINT) AS offsides,
           CAST(o_orderpriority[1] AS BIGINT) AS yellow_cards, CAST(NULL AS BIGINT) AS red_cards,
           CAST(NULL AS BIGINT) AS goalkeeper_saves, CAST(500 AS BIGINT) AS total_passes,
           CAST(NULL AS BIGINT) AS passes_accurate,
           CAST(o_orderpriority[1] AS BIGINT) * 10 + 5 AS ball_possession_pct, o_custkey AS passes_pct
    FROM orders WHERE o_orderpriority <> '5-LOW'
    """,
)
def stg_fixture_statistics(t):
    return plans.stg_fixture_statistics(derived.raw_fixture_statistics(t.orders))


@query(
    "stg_fixture_players_statistics",
    f"""
    WITH s AS (
      SELECT {AT.format("o_orderkey")} AS ingested_at, o_custkey // 100 AS league_id,
             CAST(year(o_orderdate) AS INTEGER) AS season, o_orderkey AS fixture_id, o_custkey AS team_id,
             'Team ' || o_custkey AS team_name, o_orderpriority, o_orderstatus, o_custkey FROM orders)
    SELECT ingested_at, league_id, season, fixture_id, team_id, team_name, o_custkey AS player_id,
           ' Player ' || o_custkey || ' ' AS player_name, 'p' AS player_photo_url,
           CAST(o_orderpriority[1] AS BIGINT) AS offsides, CAST(1 AS BIGINT) AS yellow, fixture_id AS minutes FROM s
    UNION ALL
    SELECT ingested_at, league_id, season, fixture_id, team_id, team_name, o_custkey,
           ' Player ' || o_custkey || ' ', 'p', NULL, 2, 0 FROM s
    UNION ALL
    SELECT ingested_at, league_id, season, fixture_id, team_id, team_name, o_custkey + 100000, '  ', 'p', 21, 0, 7
    FROM s WHERE o_orderstatus <> 'P'
    """,
)
def stg_fixture_players_statistics(t):
    staged = plans.stg_fixture_players_statistics(derived.raw_fixture_players_statistic(t.orders))
    return staged.select(
        *[c for c in staged.columns if not c.endswith("_json")],
        _num("cards_json", "$.yellow", "yellow"),
        _num("games_json", "$.minutes", "minutes"),
    )


@query(
    "stg_fixture_predictions",
    f"""
    SELECT {AT.format("o_orderkey")} AS ingested_at, o_custkey // 100 AS league_id,
           CAST(year(o_orderdate) AS INTEGER) AS season, o_orderkey AS fixture_id,
           CASE WHEN o_orderstatus <> 'P' THEN 'Win ' || o_custkey END AS advice,
           CAST(CASE WHEN o_orderstatus <> 'O' THEN 25 END AS BIGINT) AS percent_away,
           CAST(o_orderpriority[1] AS BIGINT) * 10 AS percent_home, CAST(45 AS BIGINT) AS percent_draw,
           o_custkey + 7 AS team_away_id, 'Team ' || (o_custkey + 7) AS team_away_name,
           o_custkey AS team_home_id, 'Team ' || o_custkey AS team_home_name,
           'LLD' AS away_form, 'WWD' AS home_form, o_orderkey + 1 AS away_played, o_orderkey AS home_played
    FROM orders
    """,
)
def stg_fixture_predictions(t):
    staged = plans.stg_fixture_predictions(derived.raw_fixture_predictions(t.orders))
    return staged.select(
        *staged.columns[:12],
        try_jget(F.col("team_away_last_5"), "$.form", "string").alias("away_form"),
        try_jget(F.col("team_home_last_5"), "$.form", "string").alias("home_form"),
        _num("team_away_league", "$.played", "away_played"),
        _num("team_home_league", "$.played", "home_played"),
    )


MANAGERS = f"""
    SELECT {AT.format("p_partkey")} AS ingested_at, p_brand AS nationality,
           CASE p_type WHEN 'ECONOMY' THEN ' ' || upper(replace(p_name, ' ', '  ')) || '!'
             WHEN 'SMALL' THEN p_brand ELSE p_name || 'é' END AS player_name
    FROM part
"""


@query("stg_football_manager", MANAGERS)
def stg_football_manager(t):
    return plans.stg_football_manager(derived.football_manager_raw(t.part)).drop("payload_json")


LIVE = f"""
    SELECT {AT.format("event_id")} AS ingested_at, 'fixture.live.events' AS topic,
           CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", CAST(user_id AS VARCHAR) AS message_key,
           CASE WHEN event_type <> 'error' THEN ts END AS kafka_timestamp, user_id AS fixture_id,
           date_trunc('second', ts) AS ingested_at_utc,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS event_elapsed_min,
           CAST(NULL AS BIGINT) AS event_extra_min,
           CASE event_type WHEN 'purchase' THEN 'Goal' WHEN 'error' THEN 'CARD' WHEN 'signup' THEN 'subst'
             ELSE 'Substitution' END AS event_type,
           CASE WHEN value > 50 THEN 'Red Card' WHEN value > 10 THEN 'Second YELLOW card' ELSE 'Foul' END AS event_detail,
           CASE WHEN event_type = 'purchase' THEN 'header' END AS event_comments, user_id + 1 AS team_id,
           'Team ' || user_id AS team_name, 'l' AS team_logo, event_id AS player_id, 'Player ' || event_id AS player_name,
           event_id + 1 AS assist_id, 'Player ' || (event_id + 1) AS assist_name
    FROM events WHERE event_type <> 'view'
"""


@query("stg_kafka_fixture_live_events", LIVE)
def stg_kafka_fixture_live_events(t):
    staged = plans.stg_kafka_fixture_live_events(derived.kafka_fixture_live_events(t.events))
    return staged.drop("message_value_json")


@query(
    "dim_fixture",
    f"""
    SELECT fixture_id, league_id, season FROM ({FIXTURES})
    QUALIFY row_number() OVER (PARTITION BY fixture_id ORDER BY ingested_at DESC NULLS FIRST, season DESC, league_id) = 1
    """,
)
def dim_fixture(t):
    staged = plans.stg_fixture_info(derived.raw_fixture_info(t.orders))
    return plans.dim_fixture(staged).drop("created_at", "updated_at")


@query(
    "dim_league",
    f"""
    WITH s AS (
      SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN {AT.format("c_custkey")} END AS ingested_at,
             c_custkey // 3 AS league_id,
             CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN ' League ' || c_nationkey || ' ' END AS league_name,
             CASE c_mktsegment WHEN 'BUILDING' THEN '  ' WHEN 'AUTOMOBILE' THEN NULL
               ELSE 'NATION_' || c_nationkey END AS country_name
      FROM customer),
    g AS (SELECT league_id, country_name, league_name, max(ingested_at) AS ingested_at FROM s GROUP BY ALL)
    SELECT league_id, nullif(trim(country_name), '') AS league_country, nullif(trim(league_name), '') AS league_name
    FROM g
    QUALIFY row_number() OVER (PARTITION BY league_id ORDER BY ingested_at DESC NULLS FIRST,
      g.league_name NULLS FIRST, country_name NULLS FIRST) = 1
    """,
)
def dim_league(t):
    return plans.dim_league(plans.stg_league(derived.raw_league(t.customer))).drop("created_at", "updated_at")


PLAYERS = f"""
    SELECT * FROM (
      SELECT {AT.format("p_partkey")} AS ingested_at, p_partkey AS player_id,
             CASE WHEN p_type <> 'SMALL' THEN p_name ELSE split_part(p_name, ' ', 1) END AS player_name,
             CAST(p_size AS BIGINT) AS player_age, p_brand AS player_nationality FROM part
      UNION ALL
      SELECT {AT.format("o_orderkey")}, o_custkey, 'Player ' || o_custkey, NULL, NULL FROM orders
      UNION ALL
      SELECT {AT.format("o_orderkey")}, o_custkey + 100000, NULL, NULL, NULL FROM orders WHERE o_orderstatus <> 'P')
    QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY ingested_at DESC NULLS FIRST,
      player_age DESC NULLS LAST, player_nationality DESC NULLS LAST, player_name DESC NULLS LAST) = 1
"""


def _players(t):
    return plans.dim_player(
        plans.stg_players_statistics(derived.raw_players_statistics(t.part)),
        plans.stg_fixture_players_statistics(derived.raw_fixture_players_statistic(t.orders)),
    )


@query("dim_player", f"SELECT player_id, player_name, player_age, player_nationality FROM ({PLAYERS})")
def dim_player(t):
    return _players(t).drop("created_at", "updated_at")


@query(
    "dim_team",
    f"""
    WITH f AS ({FIXTURES}),
    u AS (
      SELECT s_suppkey AS team_id, CASE WHEN s_acctbal < 0 THEN '   ' ELSE ' ' || s_name END AS team_name,
             CAST(s_nationkey AS BIGINT) AS league_id, {AT.format("s_suppkey")} AS ingested_at FROM supplier
      UNION ALL SELECT home_team_id, home_team_name, league_id, ingested_at FROM f
      UNION ALL SELECT away_team_id, away_team_name, league_id, ingested_at FROM f WHERE away_team_id IS NOT NULL)
    SELECT team_id, nullif(trim(team_name), '') AS team_name, league_id FROM u
    QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY ingested_at DESC NULLS FIRST, u.team_name, league_id) = 1
    """,
)
def dim_team(t):
    info = plans.stg_teams_info(derived.raw_teams_info(t.supplier))
    fixtures = plans.stg_fixture_info(derived.raw_fixture_info(t.orders))
    return plans.dim_team(info, fixtures).drop("created_at", "updated_at")


NAME_KEY = "regexp_replace(regexp_replace(lower(trim({0})), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g')"


@query(
    "fct_football_manager",
    f"""
    WITH p AS (SELECT player_id, player_name, {NAME_KEY.format("player_name")} AS k FROM ({PLAYERS})
               WHERE player_name IS NOT NULL),
    m AS (SELECT *, {NAME_KEY.format("player_name")} AS k FROM ({MANAGERS}) WHERE player_name IS NOT NULL)
    SELECT p.player_id, p.player_name AS dim_player_name, m.ingested_at, m.player_name, m.nationality,
           m.k AS player_name_key, CAST(1 AS BIGINT) AS rn
    FROM p JOIN m ON p.k = m.k
    QUALIFY row_number() OVER (PARTITION BY p.player_id ORDER BY m.ingested_at DESC NULLS FIRST) = 1
    """,
)
def fct_football_manager(t):
    managers = plans.stg_football_manager(derived.football_manager_raw(t.part))
    return plans.fct_football_manager(_players(t), managers).drop("payload_json")


@query(
    "audit_manager_player_unmatched",
    f"""
    WITH p AS (SELECT {NAME_KEY.format("player_name")} AS k FROM ({PLAYERS}) WHERE player_name IS NOT NULL)
    SELECT ingested_at, player_name, nationality, m.k AS player_name_key
    FROM (SELECT *, {NAME_KEY.format("player_name")} AS k FROM ({MANAGERS})) m
    WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = m.k)
    """,
)
def audit_manager_player_unmatched(t):
    managers = plans.stg_football_manager(derived.football_manager_raw(t.part))
    return plans.audit_manager_player_unmatched(managers, _players(t)).drop("payload_json")


FACT = f"""
    SELECT topic || ':' || "partition" || ':' || "offset" AS event_id, ingested_at, topic, "partition", "offset",
           message_key, kafka_timestamp, coalesce(kafka_timestamp, ingested_at_utc, ingested_at) AS event_time,
           fixture_id, event_elapsed_min, event_extra_min, event_type, event_detail, event_comments, team_id, team_name,
           team_logo, player_id, player_name, assist_id, assist_name
    FROM ({LIVE})
"""


def _fact(t):
    return plans.fct_fixture_live_event(
        plans.stg_kafka_fixture_live_events(derived.kafka_fixture_live_events(t.events))
    )


@query("fct_fixture_live_event", FACT)
def fct_fixture_live_event(t):
    return _fact(t)


@query(
    "fct_fixture_live_goal",
    f"""
    SELECT event_id, fixture_id, event_time, team_id, team_name, player_id AS scorer_id, player_name AS scorer_name,
           assist_id, assist_name, event_elapsed_min, event_extra_min, event_detail, event_comments
    FROM ({FACT}) WHERE event_type = 'Goal'
    """,
)
def fct_fixture_live_goal(t):
    return plans.fct_fixture_live_goal(_fact(t))


@query(
    "fct_fixture_live_card",
    f"""
    SELECT event_id, fixture_id, event_time, team_id, team_name, player_id, player_name, event_elapsed_min,
           event_extra_min, event_detail,
           CASE event_detail WHEN 'Red Card' THEN 'red' WHEN 'Second YELLOW card' THEN 'yellow' ELSE 'unknown' END AS card_color
    FROM ({FACT}) WHERE event_type = 'CARD'
    """,
)
def fct_fixture_live_card(t):
    return plans.fct_fixture_live_card(_fact(t))


@query(
    "fct_fixture_live_substitution",
    f"""
    SELECT event_id, fixture_id, event_time, team_id, team_name, event_elapsed_min, event_extra_min,
           player_id AS player_out_id, player_name AS player_out_name, assist_id AS player_in_id,
           assist_name AS player_in_name, event_detail
    FROM ({FACT}) WHERE event_type IN ('subst', 'Substitution')
    """,
)
def fct_fixture_live_substitution(t):
    return plans.fct_fixture_live_substitution(_fact(t))
