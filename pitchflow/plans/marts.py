"""Marts: dimensions, facts and the audit, from staged tables.

`as_of` is the build time stamped on dimension rows (default: now). Ties between equally new rows
are broken by the remaining columns, so a rebuild gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.functions import blank_to_null, card_color, event_id, event_time, full_name
from pitchflow.operators.dedup import group_max, latest_by
from pitchflow.operators.joins import match_latest, unmatched
from pitchflow.operators.union import union_padded, unpivot_sides


def _stamped(df: DataFrame, columns: list[str], as_of: Column | None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return df.select(*columns, now.alias("created_at"), now.alias("updated_at"))


def dim_fixture(stg_fixture_info: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Newest league and season per fixture."""
    src = stg_fixture_info.select("fixture_id", "league_id", "season", "ingested_at")
    newest = latest_by(src, ["fixture_id"], "ingested_at", [F.col("season").desc(), F.col("league_id")])
    return _stamped(newest, ["fixture_id", "league_id", "season"], as_of)


def dim_league(stg_league: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Newest name and country per league."""
    rows = stg_league.filter(F.col("league_id").isNotNull())
    newest = group_max(rows, ["league_id", "country_name", "league_name"], "ingested_at")
    ties = [F.col("league_name"), F.col("country_name")]
    one = latest_by(newest, ["league_id"], "ingested_at", ties)
    named = one.select(
        "league_id",
        blank_to_null(F.col("country_name")).alias("league_country"),
        blank_to_null(F.col("league_name")).alias("league_name"),
    )
    return _stamped(named, ["league_id", "league_country", "league_name"], as_of)


def dim_player(
    stg_players_statistics: DataFrame, stg_fixture_players_statistics: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Newest name, age and nationality per player, from season and match statistics."""
    schema = T.StructType.fromDDL(
        "ingested_at timestamp_ntz, player_id bigint, player_name string, player_age bigint, player_nationality string"
    )
    season = stg_players_statistics.filter(F.col("player_id").isNotNull()).withColumn(
        "player_name", full_name(F.col("player_first_name"), F.col("player_last_name"))
    )
    match = stg_fixture_players_statistics.filter(F.col("player_id").isNotNull()).select(
        "ingested_at", "player_id", blank_to_null(F.col("player_name")).alias("player_name")
    )
    ties = [F.col(c).desc_nulls_last() for c in ("player_age", "player_nationality", "player_name")]
    newest = latest_by(union_padded(season, match, schema=schema), ["player_id"], "ingested_at", ties)
    return _stamped(newest, ["player_id", "player_name", "player_age", "player_nationality"], as_of)


def dim_team(stg_teams_info: DataFrame, stg_fixture_info: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Newest name and league per team, from team info and both sides of the fixtures."""
    schema = T.StructType.fromDDL("team_id bigint, team_name string, league_id bigint, ingested_at timestamp_ntz")
    info = stg_teams_info.filter(F.col("team_id").isNotNull())
    played = unpivot_sides(
        stg_fixture_info,
        ["home_team_id", "home_team_name"],
        ["away_team_id", "away_team_name"],
        ["team_id", "team_name"],
        ["league_id", "ingested_at"],
    )
    ties = [F.col("team_name").asc_nulls_last(), F.col("league_id")]
    newest = latest_by(union_padded(info, played, schema=schema), ["team_id"], "ingested_at", ties)
    named = newest.withColumn("team_name", blank_to_null(F.col("team_name")))
    return _stamped(named, ["team_id", "team_name", "league_id"], as_of)


def fct_football_manager(dim_player: DataFrame, stg_football_manager: DataFrame, min_key_length: int = 0) -> DataFrame:
    """Players with the newest manager row of the same name key."""
    players = dim_player.select("player_id", F.col("player_name").alias("dim_player_name"))
    newest = [F.col("ingested_at").desc_nulls_first(), F.col("player_name"), F.col("nationality")]
    key = "player_name_key"
    matched = match_latest(
        players,
        stg_football_manager,
        "dim_player_name",
        "player_name",
        ["player_id"],
        newest,
        key,
        min_key_length,
    )
    return matched.select(
        "player_id", "dim_player_name", *stg_football_manager.columns, key, F.lit(1).cast("bigint").alias("rn")
    )


def audit_manager_player_unmatched(stg_football_manager: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Manager rows whose name key no player has."""
    key = "player_name_key"
    spread = ["ingested_at", "player_name", "nationality"]
    found = unmatched(stg_football_manager, dim_player, "player_name", "player_name", spread, key)
    return found.select(*stg_football_manager.columns, key)


# Columns of the live fact that come from the staged event as they are.
_LOG_COLUMNS = ("ingested_at", "topic", "partition", "offset", "message_key", "kafka_timestamp")
_EVENT_COLUMNS = (
    "fixture_id",
    "event_elapsed_min",
    "event_extra_min",
    "event_type",
    "event_detail",
    "event_comments",
    "team_id",
    "team_name",
    "team_logo",
    "player_id",
    "player_name",
    "assist_id",
    "assist_name",
)


def fct_fixture_live_event(stg_events: DataFrame) -> DataFrame:
    """Live events with their id and time; `merge_incremental` keeps the stored fact up to date."""
    return stg_events.select(
        event_id(F.col("topic"), F.col("partition"), F.col("offset")).alias("event_id"),
        *_LOG_COLUMNS,
        event_time(F.col("kafka_timestamp"), F.col("ingested_at_utc"), F.col("ingested_at")).alias("event_time"),
        *_EVENT_COLUMNS,
    )


_SHARED = ("event_id", "fixture_id", "event_time", "team_id", "team_name")


def fct_fixture_live_goal(fact: DataFrame) -> DataFrame:
    """Goals: the player is the scorer."""
    return fact.filter(F.lower("event_type") == "goal").select(
        *_SHARED,
        F.col("player_id").alias("scorer_id"),
        F.col("player_name").alias("scorer_name"),
        "assist_id",
        "assist_name",
        "event_elapsed_min",
        "event_extra_min",
        "event_detail",
        "event_comments",
    )


def fct_fixture_live_card(fact: DataFrame) -> DataFrame:
    """Cards with their colour."""
    return fact.filter(F.lower("event_type") == "card").select(
        *_SHARED,
        "player_id",
        "player_name",
        "event_elapsed_min",
        "event_extra_min",
        "event_detail",
        card_color(F.col("event_detail")).alias("card_color"),
    )


def fct_fixture_live_substitution(fact: DataFrame) -> DataFrame:
    """Substitutions: the player goes out, the assist comes in."""
    return fact.filter(F.lower("event_type").isin("subst", "substitution")).select(
        *_SHARED,
        "event_elapsed_min",
        "event_extra_min",
        F.col("player_id").alias("player_out_id"),
        F.col("player_name").alias("player_out_name"),
        F.col("assist_id").alias("player_in_id"),
        F.col("assist_name").alias("player_in_name"),
        "event_detail",
    )
