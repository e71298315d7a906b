"""The declared checks of every staging model."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchflow.functions import array_size, is_object
from pitchflow.quality.checks import Check, accepted_range, expression_is_true, not_null, unique_combination

# Columns that must not be NULL, per model.
NOT_NULL = {
    "stg_league": ("league_id", "season", "ingested_at", "country_name", "country_code"),
    "stg_teams_info": (
        "league_id",
        "season",
        "ingested_at",
        "team_id",
        "team_name",
        "team_founded",
        "venue_id",
        "venue_name",
        "venue_capacity",
    ),
    "stg_fixture_statistics": (
        "ingested_at",
        "league_id",
        "season",
        "fixture_id",
        "team_id",
        "team_name",
        "team_logo_url",
    ),
    "stg_fixture_info": (
        "api_fixture_id",
        "league_id",
        "season",
        "fixture_date_utc",
        "fixture_timezone",
        "status_short",
        "status_long",
        "home_team_id",
        "away_team_id",
        "payload_response",
    ),
    "stg_team_statistics": ("ingested_at", "league_id", "season", "team_id"),
    "stg_fixture_line_up": ("ingested_at", "league_id", "season", "fixture_id", "team_id", "formation"),
    "stg_fixture_predictions": (
        "ingested_at",
        "league_id",
        "season",
        "fixture_id",
        "team_home_id",
        "team_away_id",
        "advice",
    ),
    "stg_player_trophies": ("league_id", "player_id", "trophy_1_league", "trophy_1_place", "payload_json"),
    "stg_players_statistics": (
        "player_id",
        "league_id",
        "season",
        "team_id",
        "games_json",
        "goals_json",
        "passes_json",
    ),
    "stg_fixture_players_statistics": (
        "ingested_at",
        "league_id",
        "season",
        "fixture_id",
        "team_id",
        "player_id",
        "player_name",
    ),
    "stg_football_manager": ("ingested_at", "player_name"),
    "stg_kafka_fixture_live_events": ("topic", "partition", "offset", "message_key", "fixture_id"),
}

# Column combinations that identify a row, and whether a repeat is an error.
UNIQUE = {
    "stg_league": (("league_id", "season"), "error"),
    "stg_teams_info": (("league_id", "team_id", "season"), "warn"),
    "stg_fixture_statistics": (("league_id", "season", "fixture_id", "team_id"), "error"),
    "stg_fixture_info": (("league_id", "season", "api_fixture_id", "home_team_id", "away_team_id"), "warn"),
    "stg_team_statistics": (("league_id", "season", "team_id", "ingested_at"), "error"),
    "stg_fixture_predictions": (("league_id", "season", "fixture_id"), "warn"),
    "stg_player_trophies": (("player_id", "trophy_1_league", "trophy_1_place", "trophy_1_season"), "error"),
    "stg_fixture_players_statistics": (
        ("ingested_at", "fixture_id", "team_id", "player_id", "player_name"),
        "error",
    ),
    "stg_kafka_fixture_live_events": (("topic", "partition", "offset"), "error"),
}

# Sections of a player's match statistics.
MATCH_SECTIONS = ("cards", "dribbles", "duels", "fouls", "games", "goals", "passes", "penalty", "shots", "tackles")


def _percent(column: str) -> Check:
    return expression_is_true(f"{column} is null or {column} between 0 and 100", column)


def _section_is_object(section: str) -> Check:
    c = f"{section}_json"
    return expression_is_true(lambda: F.col(c).isNull() | is_object(F.col(c)), c)


def _any_section():
    known = F.col("offsides").isNotNull()
    for section in MATCH_SECTIONS:
        known = known | F.col(f"{section}_json").isNotNull()
    return known


CONDITIONS: dict[str, list[Check]] = {
    "stg_league": [expression_is_true("country_code is null or country_code rlike '^[A-Z]{2}(-[A-Z]{3})?$'", "country_code")],
    "stg_fixture_statistics": [_percent("ball_possession_pct"), _percent("passes_pct")],
    "stg_team_statistics": [
        accepted_range(c, 0, where=f"{c} is not null")
        for c in ("fixtures_played_total", "goals_for_total", "goals_against_total")
    ],
    "stg_fixture_line_up": [
        expression_is_true(lambda: array_size(F.col("start_xi_json")) == 11, "start_xi_json"),
        expression_is_true(lambda: array_size(F.col("substitutes_json")) >= 0, "substitutes_json"),
    ],
    "stg_fixture_predictions": [
        _percent("percent_away"),
        _percent("percent_home"),
        _percent("percent_draw"),
        expression_is_true(
            "percent_away is null or percent_home is null or percent_draw is null"
            " or percent_away + percent_home + percent_draw between 99 and 101",
            "percent_sum",
        ),
    ],
    "stg_player_trophies": [
        expression_is_true("trophy_1_league is not null and trophy_1_season is not null", "trophy_1")
    ],
    "stg_players_statistics": [
        expression_is_true("player_age is null or player_age between 15 and 50", "player_age"),
        expression_is_true("player_photo_url is null or player_photo_url like 'https:%'", "player_photo_url"),
    ],
    "stg_fixture_players_statistics": [
        accepted_range("offsides", 0, 20),
        *[_section_is_object(s) for s in MATCH_SECTIONS],
        expression_is_true(_any_section, "any_section"),
    ],
    "stg_kafka_fixture_live_events": [
        expression_is_true("try_cast(message_key as bigint) = fixture_id", "message_key")
    ],
}


def _checks(model: str) -> list[Check]:
    out = [not_null(c) for c in NOT_NULL[model]]
    if model in UNIQUE:
        columns, severity = UNIQUE[model]
        out.append(unique_combination(columns, severity))
    return out + CONDITIONS.get(model, [])


CHECKS: dict[str, list[Check]] = {model: _checks(model) for model in NOT_NULL}
