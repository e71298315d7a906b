"""Staging models: typed projections of one RAW table each.

A model is a function from the RAW DataFrame to the staged one. Payloads may be VARIANT (as RAW
tables store them) or JSON text; either way each payload is parsed at most once, and a projection
model is a single stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.functions import (
    array_size,
    elements,
    jget,
    number,
    parsed,
    percent_to_number,
    try_jget,
    try_to_number,
)
from pitchflow.operators.dedup import first_n_by
from pitchflow.operators.pivot import pivot_max, rank_pivot

_KEYS = ("ingested_at", "league_id", "season")
_FIXTURE_KEYS = (*_KEYS, "fixture_id")

# Staged column -> path and type inside the payload. `number` is a whole number
# (rounded half up), `variant` keeps the JSON value.
LEAGUE = {
    "league_id_from_payload": ("league.id", "number"),
    "league_name": ("league.name", "string"),
    "league_type": ("league.type", "string"),
    "league_logo": ("league.logo", "string"),
    "country_name": ("country.name", "string"),
    "country_code": ("country.code", "string"),
    "country_flag": ("country.flag", "string"),
}
TEAMS_INFO = {
    "api_team_id": ("team.id", "number"),
    "team_name": ("team.name", "string"),
    "team_code": ("team.code", "string"),
    "team_country": ("team.country", "string"),
    "team_founded": ("team.founded", "number"),
    "is_national_team": ("team.national", "boolean"),
    "team_logo_url": ("team.logo", "string"),
    "venue_id": ("venue.id", "number"),
    "venue_name": ("venue.name", "string"),
    "venue_address": ("venue.address", "string"),
    "venue_city": ("venue.city", "string"),
    "venue_capacity": ("venue.capacity", "number"),
    "venue_surface": ("venue.surface", "string"),
    "venue_image_url": ("venue.image", "string"),
}
TEAM_STATISTICS = {
    "team_id": ("team.id", "number"),
    "team_name": ("team.name", "string"),
    "team_logo_url": ("team.logo", "string"),
    "form": ("form", "string"),
    "fixtures_played_total": ("fixtures.played.total", "number"),
    "fixtures_wins_total": ("fixtures.wins.total", "number"),
    "fixtures_draws_total": ("fixtures.draws.total", "number"),
    "fixtures_loses_total": ("fixtures.loses.total", "number"),
    "goals_for_total": ("goals.for.total.total", "number"),
    "goals_against_total": ("goals.against.total.total", "number"),
    "goals_for_avg_total": ("goals.for.average.total", "percent"),
    "goals_against_avg_total": ("goals.against.average.total", "percent"),
    "clean_sheet_total": ("clean_sheet.total", "number"),
    "failed_to_score_total": ("failed_to_score.total", "number"),
    "penalty_scored_total": ("penalty.scored.total", "number"),
    "penalty_missed_total": ("penalty.missed.total", "number"),
}
PLAYERS_STATISTICS = {
    "team_id": ("statistics[0].team.id", "number"),
    "player_id": ("player.id", "number"),
    "player_first_name": ("player.firstname", "string"),
    "player_last_name": ("player.lastname", "string"),
    "player_age": ("player.age", "number"),
    "player_nationality": ("player.nationality", "string"),
    "player_photo_url": ("player.photo", "string"),
}
PLAYERS_STATISTICS_SECTIONS = (
    "team",
    "league",
    "games",
    "substitutes",
    "shots",
    "goals",
    "passes",
    "tackles",
    "duels",
    "dribbles",
    "fouls",
    "cards",
    "penalty",
)
FIXTURE_INFO = {
    "api_fixture_id": ("fixture.id", "number"),
    "fixture_date_utc": ("fixture.date", "timestamp"),
    "fixture_timestamp": ("fixture.timestamp", "number"),
    "fixture_timezone": ("fixture.timezone", "string"),
    "referee": ("fixture.referee", "string"),
    "period_first_ts": ("fixture.periods.first", "number"),
    "period_second_ts": ("fixture.periods.second", "number"),
    "status_elapsed": ("fixture.status.elapsed", "number"),
    "status_extra": ("fixture.status.extra", "number"),
    "status_long": ("fixture.status.long", "string"),
    "status_short": ("fixture.status.short", "string"),
    "venue_id": ("fixture.venue.id", "number"),
    "venue_name": ("fixture.venue.name", "string"),
    "venue_city": ("fixture.venue.city", "string"),
    "goals_home": ("goals.home", "number"),
    "goals_away": ("goals.away", "number"),
    "api_league_id": ("league.id", "number"),
    "league_name": ("league.name", "string"),
    "league_country": ("league.country", "string"),
    "league_season": ("league.season", "number"),
    "league_round": ("league.round", "string"),
    "league_standings": ("league.standings", "boolean"),
    "league_logo_url": ("league.logo", "string"),
    "league_flag_url": ("league.flag", "string"),
    "home_team_id": ("teams.home.id", "number"),
    "home_team_name": ("teams.home.name", "string"),
    "home_team_logo_url": ("teams.home.logo", "string"),
    "home_team_winner": ("teams.home.winner", "boolean"),
    "away_team_id": ("teams.away.id", "number"),
    "away_team_name": ("teams.away.name", "string"),
    "away_team_logo_url": ("teams.away.logo", "string"),
    "away_team_winner": ("teams.away.winner", "boolean"),
    "score_ht_home": ("score.halftime.home", "number"),
    "score_ht_away": ("score.halftime.away", "number"),
    "score_ft_home": ("score.fulltime.home", "number"),
    "score_ft_away": ("score.fulltime.away", "number"),
    "score_et_home": ("score.extratime.home", "number"),
    "score_et_away": ("score.extratime.away", "number"),
    "score_p_home": ("score.penalty.home", "number"),
    "score_p_away": ("score.penalty.away", "number"),
}
FIXTURE_LINE_UP = {
    "team_id": ("team.id", "number"),
    "team_name": ("team.name", "string"),
    "team_logo_url": ("team.logo", "string"),
    "team_colors": ("team.colors", "variant"),
    "coach_id": ("coach.id", "number"),
    "coach_name": ("coach.name", "string"),
    "coach_photo_url": ("coach.photo", "string"),
    "formation": ("formation", "string"),
    "start_xi_json": ("startXI", "variant"),
    "substitutes_json": ("substitutes", "variant"),
    "start_xi_cnt": ("startXI", "size"),
    "substitutes_cnt": ("substitutes", "size"),
}
FIXTURE_STATISTICS_TEAM = {
    "team_id": ("team.id", "number"),
    "team_name": ("team.name", "string"),
    "team_logo_url": ("team.logo", "string"),
}
FIXTURE_STATISTICS_TYPES = {
    "Shots on Goal": ("shots_on_goal", try_to_number),
    "Shots off Goal": ("shots_off_goal", try_to_number),
    "Total Shots": ("total_shots", try_to_number),
    "Blocked Shots": ("blocked_shots", try_to_number),
    "Shots insidebox": ("shots_inside_box", try_to_number),
    "Shots outsidebox": ("shots_outside_box", try_to_number),
    "Fouls": ("fouls", try_to_number),
    "Corner Kicks": ("corner_kicks", try_to_number),
    "Offsides": ("offsides", try_to_number),
    "Yellow Cards": ("yellow_cards", try_to_number),
    "Red Cards": ("red_cards", try_to_number),
    "Goalkeeper Saves": ("goalkeeper_saves", try_to_number),
    "Total passes": ("total_passes", try_to_number),
    "Passes accurate": ("passes_accurate", try_to_number),
    "Ball Possession": ("ball_possession_pct", percent_to_number),
    "Passes %": ("passes_pct", percent_to_number),
}
FIXTURE_PLAYER = {
    "player_id": ("player.id", "number"),
    "player_name": ("player.name", "string"),
    "player_photo_url": ("player.photo", "string"),
}
FIXTURE_PLAYER_STATISTICS = {
    "cards_json": ("cards", "variant"),
    "dribbles_json": ("dribbles", "variant"),
    "duels_json": ("duels", "variant"),
    "fouls_json": ("fouls", "variant"),
    "games_json": ("games", "variant"),
    "goals_json": ("goals", "variant"),
    "offsides": ("offsides", "try_number"),
    "passes_json": ("passes", "variant"),
    "penalty_json": ("penalty", "variant"),
    "shots_json": ("shots", "variant"),
    "tackles_json": ("tackles", "variant"),
}
FIXTURE_PREDICTIONS = {
    "advice": ("predictions.advice", "string"),
    "percent_away": ("predictions.percent.away", "percent"),
    "percent_home": ("predictions.percent.home", "percent"),
    "percent_draw": ("predictions.percent.draw", "percent"),
    "team_away_id": ("teams.away.id", "number"),
    "team_away_name": ("teams.away.name", "string"),
    "team_home_id": ("teams.home.id", "number"),
    "team_home_name": ("teams.home.name", "string"),
    "team_away_last_5": ("teams.away.last_5", "variant"),
    "team_home_last_5": ("teams.home.last_5", "variant"),
    "team_away_league": ("teams.away.league", "variant"),
    "team_home_league": ("teams.home.league", "variant"),
}
LIVE_EVENT = {
    "fixture_id": ("fixture_id", "number"),
    "ingested_at_utc": ("ingested_at_utc", "timestamp_ntz"),
    "event_elapsed_min": ("event.time.elapsed", "number"),
    "event_extra_min": ("event.time.extra", "number"),
    "event_type": ("event.type", "string"),
    "event_detail": ("event.detail", "string"),
    "event_comments": ("event.comments", "string"),
    "team_id": ("event.team.id", "number"),
    "team_name": ("event.team.name", "string"),
    "team_logo": ("event.team.logo", "string"),
    "player_id": ("event.player.id", "number"),
    "player_name": ("event.player.name", "string"),
    "assist_id": ("event.assist.id", "number"),
    "assist_name": ("event.assist.name", "string"),
}
TROPHY_SLOTS = 3
TROPHIES_PER_PLAYER = 20


def _read(p: Column, path: str, kind: str) -> Column:
    at = f"$.{path}"
    if kind == "number":
        return number(p, at)
    if kind == "size":
        return array_size(p, at)
    if kind == "variant":
        return try_jget(p, at, "variant")
    if kind == "percent":
        return percent_to_number(jget(p, at, "string"))
    if kind == "try_number":
        return try_to_number(jget(p, at, "string"))
    return jget(p, at, kind)


def _columns(p: Column, spec: Mapping[str, tuple[str, str]]) -> Iterator[Column]:
    for name, (path, kind) in spec.items():
        yield _read(p, path, kind).alias(name)


def _project(
    raw: DataFrame,
    keys: tuple[str, ...],
    spec: Mapping[str, tuple[str, str]],
    whole: str | None = None,
    keep_null: bool = False,
) -> DataFrame:
    """`keys`, the columns of `spec`, and the whole payload under the name `whole`."""
    rows = parsed(raw, "payload", "_p", keep_null)
    p = F.col("_p")
    return rows.select(*keys, *_columns(p, spec), *([p.alias(whole)] if whole else []))


def _each(df: DataFrame, keep: Sequence[str], items: str, name: str) -> DataFrame:
    """`keep` once per element of the array column `items`, the element under `name`.

    An inner explode of a computed array adds a filter on its size and on NULL, and the array is
    then computed again for each of them; the outer one does not. A JSON null is not NULL and stays.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def stg_league(raw: DataFrame) -> DataFrame:
    """League and country; a row whose payload does not parse stays, with NULLs."""
    return _project(raw, _KEYS, LEAGUE, "payload", keep_null=True)


def stg_teams_info(raw: DataFrame) -> DataFrame:
    """Team and venue."""
    return _project(raw, (*_KEYS, "team_id"), TEAMS_INFO, "payload_json")


def stg_team_statistics(raw: DataFrame) -> DataFrame:
    """Season totals of a team; averages are rounded to whole numbers. Unparsable rows stay, with NULLs."""
    return _project(raw, _KEYS, TEAM_STATISTICS, "payload_json", keep_null=True)


def stg_players_statistics(raw: DataFrame) -> DataFrame:
    """Player and the sections of the first statistics entry."""
    sections = {f"{s}_json": (f"statistics[0].{s}", "variant") for s in PLAYERS_STATISTICS_SECTIONS}
    return _project(raw, _KEYS, PLAYERS_STATISTICS | sections)


def stg_fixture_info(raw: DataFrame) -> DataFrame:
    """Fixture, status, venue, league, teams and scores."""
    return _project(raw, _FIXTURE_KEYS, FIXTURE_INFO, "payload_response")


def stg_fixture_line_up(raw: DataFrame) -> DataFrame:
    """Team, coach, formation, the line-up arrays and their lengths."""
    return _project(raw, _FIXTURE_KEYS, FIXTURE_LINE_UP)


def stg_fixture_predictions(raw: DataFrame) -> DataFrame:
    """Advice, percentages and teams."""
    return _project(raw, _FIXTURE_KEYS, FIXTURE_PREDICTIONS, "payload_json")


def stg_fixture_statistics(raw: DataFrame) -> DataFrame:
    """Sixteen statistics side by side, one row per ingest, fixture and team.

    The entries get a select of their own below the explode: in one select with it the explode
    would carry the payload and the team paths would be read again for every entry. The rows of a
    payload are combined before the one shuffle.
    """
    rows = parsed(raw, "payload", "_p")
    p = F.col("_p")
    keys = (*_FIXTURE_KEYS, *FIXTURE_STATISTICS_TEAM)
    teams = rows.select(
        *_FIXTURE_KEYS, *_columns(p, FIXTURE_STATISTICS_TEAM), elements(p, "$.statistics").alias("_entries")
    )
    entry = F.col("_entry")
    stats = _each(teams, keys, "_entries", "_entry").select(
        *keys, jget(entry, "$.type", "string").alias("stat_type"), jget(entry, "$.value", "string").alias("stat_value")
    )
    return pivot_max(stats, keys, "stat_type", "stat_value", FIXTURE_STATISTICS_TYPES)


def stg_fixture_players_statistics(raw: DataFrame) -> DataFrame:
    """One row per player and statistics entry, sections kept as JSON."""
    rows = parsed(raw, "payload", "_p")
    p = F.col("_p")
    teams = rows.select(
        *_FIXTURE_KEYS,
        number(p, "$.team.id").alias("team_id"),
        jget(p, "$.team.name", "string").alias("team_name"),
        elements(p, "$.players").alias("_players"),
    )
    keys = (*_FIXTURE_KEYS, "team_id", "team_name")
    player = F.col("_player")
    players = _each(teams, keys, "_players", "_player").select(
        *keys, *_columns(player, FIXTURE_PLAYER), elements(player, "$.statistics").alias("_entries")
    )
    keys = (*keys, *FIXTURE_PLAYER)
    return _each(players, keys, "_entries", "_entry").select(
        *keys, *_columns(F.col("_entry"), FIXTURE_PLAYER_STATISTICS)
    )


def stg_player_trophies(raw: DataFrame) -> DataFrame:
    """Per player, the first three trophies side by side.

    A payload is one player `{id, trophies}` or a batch `{response: [players]}`. At most 20 trophies
    of a player count, in list order; equal positions from several ingests go by ingest time, then
    season and content. The payload of a player is the largest by JSON text: it travels once per
    list, with the first trophy, which sorts before the others of its list. A list's trophies have
    different positions, so those beyond its first 20 can never count and are not unfolded.
    """
    rows = parsed(raw, "payload", "_p")
    p = F.col("_p")
    people = rows.select(*_KEYS, F.explode(F.coalesce(elements(p, "$.response"), F.array(p))).alias("_player"))
    player = F.col("_player")
    fields = ("league", "season", "place")

    def trophy(t: Column, pos: Column) -> Column:
        text = F.when(pos == 0, F.to_json(player))
        parts = [jget(t, f"$.{f}", "string").alias(f"_{f}") for f in fields]
        return F.struct(pos.alias("_pos"), text.alias("_text"), *parts)

    listed = F.transform(F.slice(elements(player, "$.trophies"), 1, TROPHIES_PER_PLAYER), trophy)
    lists = people.select(*_KEYS, number(player, "$.id").alias("player_id"), listed.alias("_trophies"))
    trophies = _each(lists, (*_KEYS, "player_id"), "_trophies", "_trophy").select(*_KEYS, "player_id", "_trophy.*")
    order = [F.col(c) for c in ("_pos", "ingested_at", "season", "league_id", "_league", "_season", "_place")]
    ranked = first_n_by(trophies, ["player_id"], order, TROPHIES_PER_PLAYER, "_rank")
    carry = [F.max("league_id").alias("league_id"), F.max("_text").alias("_text")]
    slot = {f: F.col(f"_{f}") for f in fields}
    wide = rank_pivot(ranked, ["player_id"], "_rank", slot, TROPHY_SLOTS, carry, "trophy_{rank}_{field}")
    slots = [f"trophy_{i}_{f}" for i in range(1, TROPHY_SLOTS + 1) for f in fields]
    return wide.select("player_id", "league_id", F.parse_json("_text").alias("payload_json"), *slots)


def stg_football_manager(raw: DataFrame) -> DataFrame:
    """Player name and nationality of a manager-dataset row.

    The name column may carry the byte order mark of its file.
    """
    rows = parsed(raw, "payload", "_p")
    p = F.col("_p")
    name = F.coalesce(jget(p, "$['\ufeffName']", "string"), jget(p, "$.Name", "string"))
    return rows.select(
        "ingested_at", name.alias("player_name"), jget(p, "$.Nationality", "string").alias("nationality"), p.alias("payload_json")
    )


def stg_kafka_fixture_live_events(raw: DataFrame) -> DataFrame:
    """Log metadata and the fields of a live event; a text value is parsed once more."""
    rows = raw
    if isinstance(raw.schema["message_value"].dataType, T.VariantType):
        value = F.col("message_value")
        inner = F.try_variant_get(value, "$", "string")
        is_text = F.try_variant_get(value, "$", "map<string,variant>").isNull()
        rows = raw.withColumn("message_value", F.when(is_text, F.try_parse_json(inner)).otherwise(value))
    rows = parsed(rows, "message_value", "_p")
    p = F.col("_p")
    return rows.select(
        "ingested_at",
        "topic",
        "partition",
        "offset",
        "message_key",
        "kafka_timestamp",
        p.alias("message_value_json"),
        *_columns(p, LIVE_EVENT),
    )
