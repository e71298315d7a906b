"""RAW tables derived row by row from the given tables.

Each is a projection of one table into keys and a JSON text payload of the shape the staging models
read, with the irregularities of real responses: missing parts, broken text, numbers as text,
percentages, several versions of a key. They grow with the tables they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a table that one task turns into payloads.
TASK_ROWS = 20_000

BASE = "TIMESTAMP_NTZ'2025-01-01 00:00:00'"


def _seconds(n: str) -> str:
    return f"{BASE} + make_dt_interval(0, 0, 0, {n})"


def spread(table: DataFrame) -> DataFrame:
    """The same rows dealt over as many tasks as their number asks for.

    A payload is many times the size of its row, and a small file or a row group is read by one task, however many rows it
    has: without this, that task would build, parse and sort all payloads. The count comes from the files' footers.
    """
    return table.repartition(max(1, -(-table.count() // TASK_ROWS)))


def raw_league(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        f"CASE WHEN c_mktsegment <> 'MACHINERY' THEN {_seconds('c_custkey')} END AS ingested_at",
        "c_custkey div 3 AS league_id",
        "cast(2020 + c_custkey % 3 AS int) AS season",
        """CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '{"league":' ELSE to_json(struct(
             struct(c_custkey div 3 AS id, concat(' League ', c_nationkey, ' ') AS name, c_mktsegment AS type,
                    concat('https://img/', c_custkey) AS logo) AS league,
             struct(CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE concat('NATION_', c_nationkey) END AS name,
                    CASE WHEN c_acctbal >= 0 THEN concat('N', char(65 + c_nationkey)) ELSE 'n1' END AS code,
                    concat('https://flag/', c_nationkey) AS flag) AS country)) END AS payload""",
    )


def raw_teams_info(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        f"{_seconds('s_suppkey')} AS ingested_at",
        "cast(s_nationkey AS bigint) AS league_id",
        "2025 AS season",
        "s_suppkey AS team_id",
        """to_json(struct(
             struct(s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN '   ' ELSE concat(' ', s_name) END AS name,
                    concat('S', s_nationkey) AS code, concat('NATION_', s_nationkey) AS country,
                    1900 + s_nationkey AS founded, CASE WHEN s_acctbal > 5000 THEN 'true' ELSE 'false' END AS national,
                    concat('https://img/', s_suppkey) AS logo) AS team,
             struct(s_suppkey + 1000 AS id, concat('Park ', s_suppkey) AS name, concat(s_suppkey, ' St') AS address,
                    concat('City ', s_nationkey) AS city, cast(20000 + s_suppkey AS string) AS capacity,
                    'grass' AS surface, concat('https://venue/', s_suppkey) AS image) AS venue)) AS payload""",
    )


def raw_teams_statistics(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        f"{_seconds('c_custkey')} AS ingested_at",
        "cast(c_nationkey AS bigint) AS league_id",
        "2024 AS season",
        """to_json(struct(
             struct(c_custkey AS id, c_name AS name, concat('https://img/', c_custkey) AS logo) AS team,
             CASE WHEN c_acctbal >= 0 THEN 'WDL' END AS form,
             struct(struct(38 AS total) AS played, struct(c_nationkey AS total) AS wins,
                    struct(cast(38 - c_nationkey AS string) AS total) AS draws,
                    struct(cast(NULL AS int) AS total) AS loses) AS fixtures,
             struct(struct(struct(c_custkey AS total) AS total,
                           struct(cast(c_acctbal AS string) AS total) AS average) AS `for`,
                    struct(struct(c_nationkey + 0.5BD AS total) AS total,
                           struct(CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE concat(c_nationkey, '%') END
                                  AS total) AS average) AS against) AS goals,
             struct(c_nationkey AS total) AS clean_sheet,
             struct(1 AS total) AS failed_to_score,
             struct(struct(2 AS total) AS scored, struct(c_nationkey AS total) AS missed) AS penalty)) AS payload""",
    )


def raw_players_statistics(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        f"{_seconds('p_partkey')} AS ingested_at",
        "cast(p_size AS bigint) AS league_id",
        "2025 AS season",
        "cast(p_size AS bigint) AS team_id",
        """to_json(struct(
             struct(p_partkey AS id, split(p_name, ' ')[0] AS firstname,
                    CASE WHEN p_type <> 'SMALL' THEN split(p_name, ' ')[1] END AS lastname, p_size AS age,
                    p_brand AS nationality,
                    concat(CASE WHEN p_size > 40 THEN 'http:' ELSE 'https:' END, '//photo/', p_partkey) AS photo
             ) AS player,
             CASE WHEN p_type = 'ECONOMY' THEN array() ELSE array(struct(
               struct(p_size AS id) AS team, struct(p_partkey AS minutes) AS games, struct(p_size AS total) AS goals,
               struct(1 AS total) AS passes)) END AS statistics)) AS payload""",
    )


def raw_player_trophies(part: DataFrame) -> DataFrame:
    one = """struct(p_partkey div 2 AS id, transform(sequence(1, p_size), i ->
               struct(concat(p_brand, '-', i) AS league, cast(2000 + i AS string) AS season,
                      CASE WHEN i = p_size THEN 'Winner' ELSE '2nd Place' END AS place)) AS trophies)"""
    return spread(part).selectExpr(
        f"{_seconds('p_partkey')} AS ingested_at",
        "cast(p_size AS bigint) AS league_id",
        "2025 AS season",
        "cast(p_size AS bigint) AS team_id",
        f"""CASE WHEN p_type = 'SMALL' THEN to_json(struct(p_size AS team_id, array({one}) AS response))
                 ELSE to_json({one}) END AS payload""",
    )


def raw_fixture_info(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"CASE WHEN o_orderpriority <> '5-LOW' THEN {_seconds('o_orderkey')} END AS ingested_at",
        "o_custkey div 100 AS league_id",
        "year(o_orderdate) AS season",
        "o_orderkey div 2 AS fixture_id",
        "o_custkey AS home_team_id",
        "o_custkey + 7 AS away_team_id",
        """CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL ELSE to_json(struct(
             struct(o_orderkey AS id, concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T21:00:00+07:00') AS date,
                    cast(o_orderkey * 10 AS string) AS timestamp, 'UTC' AS timezone, cast(NULL AS string) AS referee,
                    struct(o_orderkey AS first, o_orderkey + 2700 AS second) AS periods,
                    struct(CASE o_orderstatus WHEN 'F' THEN 90 WHEN 'P' THEN 45 END AS elapsed,
                           CASE o_orderstatus WHEN 'F' THEN 'Match Finished' WHEN 'P' THEN 'First Half'
                             ELSE 'Not Started' END AS long,
                           CASE o_orderstatus WHEN 'F' THEN 'FT' WHEN 'P' THEN '1H' ELSE 'NS' END AS short) AS status,
                    struct(o_custkey AS id, concat('Park ', o_custkey) AS name, 'Town' AS city) AS venue) AS fixture,
             struct(o_orderkey div 100 AS home, 1.5 AS away) AS goals,
             struct(o_custkey div 100 AS id, 'Alpha' AS name, 'X' AS country, year(o_orderdate) AS season,
                    o_orderpriority AS round, o_orderstatus = 'F' AS standings, 'u' AS logo, 'f' AS flag) AS league,
             struct(struct(o_custkey AS id, concat('Team ', o_custkey) AS name, 'h' AS logo,
                           o_totalprice > 200000 AS winner) AS home,
                    struct(CASE WHEN o_orderstatus <> 'O' THEN o_custkey + 7 END AS id,
                           concat(' Team ', o_custkey + 7, ' ') AS name, 'a' AS logo,
                           o_totalprice <= 200000 AS winner) AS away) AS teams,
             struct(struct(1 AS home, 0 AS away) AS halftime, struct(2 AS home, 1 AS away) AS fulltime,
                    struct(cast(NULL AS int) AS home, cast(NULL AS int) AS away) AS extratime,
                    struct(3 AS home) AS penalty) AS score), map('ignoreNullFields', 'false')) END AS payload""",
    )


def raw_fixture_line_up(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"{_seconds('o_orderkey')} AS ingested_at",
        "o_custkey div 100 AS league_id",
        "year(o_orderdate) AS season",
        "o_orderkey AS fixture_id",
        "o_custkey AS team_id",
        """to_json(struct(
             struct(o_custkey AS id, concat('Team ', o_custkey) AS name, 'l' AS logo, struct('red' AS home) AS colors) AS team,
             struct(o_custkey + 1 AS id, concat('Coach ', o_custkey) AS name, 'c' AS photo) AS coach,
             CASE WHEN o_orderpriority <> '2-HIGH' THEN '4-3-3' END AS formation,
             transform(sequence(1, CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 11 END), i -> struct(i AS id)) AS startXI,
             CASE o_orderstatus WHEN 'F' THEN transform(sequence(1, 7), i -> struct(i AS id))
               WHEN 'O' THEN array() END AS substitutes)) AS payload""",
    )


def raw_fixture_statistics(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"{_seconds('o_orderkey')} AS ingested_at",
        "o_custkey div 100 AS league_id",
        "year(o_orderdate) AS season",
        "o_orderkey AS fixture_id",
        "o_custkey AS team_id",
        "'home' AS side",
        """to_json(struct(
             struct(o_custkey AS id, concat('Team ', o_custkey) AS name, 'l' AS logo) AS team,
             CASE WHEN o_orderpriority = '5-LOW' THEN array() ELSE array(
               struct('Shots on Goal' AS type, cast(o_orderkey AS string) AS value),
               struct('Shots on Goal' AS type, '3' AS value),
               struct('Shots off Goal' AS type, cast(o_totalprice AS string) AS value),
               struct('Total Shots' AS type, 'x' AS value),
               struct('Blocked Shots' AS type, ' 45 ' AS value),
               struct('Shots insidebox' AS type, '1e2' AS value),
               struct('Shots outsidebox' AS type, '-2.5' AS value),
               struct('Fouls' AS type, '' AS value),
               struct('Corner Kicks' AS type, cast(o_custkey AS string) AS value),
               struct('Offsides' AS type, '4' AS value),
               struct('Yellow Cards' AS type, substring(o_orderpriority, 1, 1) AS value),
               struct('Red Cards' AS type, cast(NULL AS string) AS value),
               struct('Goalkeeper Saves' AS type, o_orderstatus AS value),
               struct('Total passes' AS type, '500' AS value),
               struct('Passes accurate' AS type, '55%' AS value),
               struct('Ball Possession' AS type, concat(substring(o_orderpriority, 1, 1), '5%') AS value),
               struct('Passes %' AS type, concat(o_custkey, '%') AS value),
               struct('expected_goals' AS type, '1.2' AS value)) END AS statistics)) AS payload""",
    )


def raw_fixture_players_statistic(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"{_seconds('o_orderkey')} AS ingested_at",
        "o_custkey div 100 AS league_id",
        "year(o_orderdate) AS season",
        "o_orderkey AS fixture_id",
        "o_custkey AS team_id",
        """to_json(struct(
             struct(o_custkey AS id, concat('Team ', o_custkey) AS name) AS team,
             array(
               struct(struct(o_custkey AS id, concat(' Player ', o_custkey, ' ') AS name, 'p' AS photo) AS player,
                      array(struct(struct(1 AS yellow) AS cards, struct(o_orderkey AS minutes) AS games,
                                   substring(o_orderpriority, 1, 1) AS offsides),
                            struct(struct(2 AS yellow) AS cards, struct(0L AS minutes) AS games,
                                   'x' AS offsides)) AS statistics),
               struct(struct(o_custkey + 100000 AS id, '  ' AS name, 'p' AS photo) AS player,
                      CASE WHEN o_orderstatus = 'P' THEN array() ELSE array(
                            struct(struct(0 AS yellow) AS cards, struct(7L AS minutes) AS games,
                                   '21' AS offsides)) END AS statistics)) AS players)) AS payload""",
    )


def raw_fixture_predictions(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"{_seconds('o_orderkey')} AS ingested_at",
        "o_custkey div 100 AS league_id",
        "year(o_orderdate) AS season",
        "o_orderkey AS fixture_id",
        """to_json(struct(
             struct(CASE WHEN o_orderstatus <> 'P' THEN concat('Win ', o_custkey) END AS advice,
                    struct(concat(substring(o_orderpriority, 1, 1), '0%') AS home, '45%' AS draw,
                           CASE WHEN o_orderstatus = 'O' THEN '5 percent' ELSE '25%' END AS away) AS percent
             ) AS predictions,
             struct(struct(o_custkey AS id, concat('Team ', o_custkey) AS name, struct('WWD' AS form) AS last_5,
                           struct(o_orderkey AS played) AS league) AS home,
                    struct(o_custkey + 7 AS id, concat('Team ', o_custkey + 7) AS name, struct('LLD' AS form) AS last_5,
                           struct(o_orderkey + 1 AS played) AS league) AS away) AS teams)) AS payload""",
    )


def football_manager_raw(part: DataFrame) -> DataFrame:
    """Manager rows whose names differ from player names in case, accents, spacing and punctuation."""
    name = """CASE p_type WHEN 'ECONOMY' THEN concat(' ', upper(replace(p_name, ' ', '  ')), '!')
                WHEN 'SMALL' THEN p_brand ELSE concat(p_name, 'é') END"""
    bom = "named_struct('\ufeffName', {0}, 'Nationality', p_brand)".format(name)
    plain = f"named_struct('Name', {name}, 'Nationality', p_brand)"
    return part.selectExpr(
        f"{_seconds('p_partkey')} AS ingested_at",
        "'players.csv' AS source_file",
        f"CASE WHEN p_size > 25 THEN to_json({bom}) ELSE to_json({plain}) END AS payload",
    )


LIVE_MESSAGE = """to_json(struct(
  concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00') AS ingested_at_utc,
  user_id AS fixture_id,
  struct(struct(get_json_object(props, '$.k') AS elapsed, cast(NULL AS int) AS extra) AS time,
         CASE event_type WHEN 'purchase' THEN 'Goal' WHEN 'error' THEN 'CARD' WHEN 'signup' THEN 'subst'
           WHEN 'click' THEN 'Substitution' ELSE 'Var' END AS type,
         CASE WHEN value > 50 THEN 'Red Card' WHEN value > 10 THEN 'Second YELLOW card' ELSE 'Foul' END AS detail,
         CASE WHEN event_type = 'purchase' THEN 'header' END AS comments,
         struct(user_id + 1 AS id, concat('Team ', user_id) AS name, 'l' AS logo) AS team,
         struct(event_id AS id, concat('Player ', event_id) AS name) AS player,
         struct(event_id + 1 AS id, concat('Player ', event_id + 1) AS name) AS assist) AS event))"""


def live_log(events: DataFrame) -> DataFrame:
    """Log messages of the live topic; views carry text that is not JSON."""
    return spread(events).selectExpr(
        "'fixture.live.events' AS topic",
        "cast(user_id % 4 AS int) AS partition",
        "event_id AS offset",
        "cast(user_id AS string) AS key",
        f"CASE WHEN event_type = 'view' THEN concat('<', props) ELSE {LIVE_MESSAGE} END AS value",
        "unix_millis(cast(ts AS timestamp)) AS timestamp",
    )


def kafka_fixture_live_events(events: DataFrame) -> DataFrame:
    """Landed live events with text values; some lack the log time."""
    return spread(events).selectExpr(
        f"{_seconds('event_id')} AS ingested_at",
        "'fixture.live.events' AS topic",
        "cast(user_id % 4 AS int) AS partition",
        "event_id AS offset",
        "cast(user_id AS string) AS message_key",
        "CASE WHEN event_type <> 'error' THEN ts END AS kafka_timestamp",
        f"CASE WHEN event_type = 'view' THEN concat('<', props) ELSE {LIVE_MESSAGE} END AS message_value",
    )


# RAW table -> the given table it is derived from, and how.
DERIVED = {
    "raw_league": ("customer", raw_league),
    "raw_teams_info": ("supplier", raw_teams_info),
    "raw_teams_statistics": ("customer", raw_teams_statistics),
    "raw_players_statistics": ("part", raw_players_statistics),
    "raw_player_trophies": ("part", raw_player_trophies),
    "raw_fixture_info": ("orders", raw_fixture_info),
    "raw_fixture_line_up": ("orders", raw_fixture_line_up),
    "raw_fixture_statistics": ("orders", raw_fixture_statistics),
    "raw_fixture_players_statistic": ("orders", raw_fixture_players_statistic),
    "raw_fixture_predictions": ("orders", raw_fixture_predictions),
    "football_manager_raw": ("part", football_manager_raw),
    "kafka_fixture_live_events": ("events", kafka_fixture_live_events),
}


def source(t, name: str) -> DataFrame:
    """One RAW table by source name."""
    table, derive = DERIVED[name]
    return derive(getattr(t, table))


def sources(t) -> dict[str, DataFrame]:
    """All RAW tables by source name."""
    return {name: source(t, name) for name in DERIVED}
