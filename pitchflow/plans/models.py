"""Model registry in reference order, and the two groups that are built together."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from pitchflow.plans import marts, staging
from pitchflow.plans.materialize import current_table, merge_incremental, read_incremental, write_table


@dataclass(frozen=True)
class Model:
    """A model function, the names of its inputs (sources or models) and how it is kept."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    kind: str = "view"
    stamped: bool = False


# Every model comes after its inputs.
MODELS: dict[str, Model] = {
    "stg_league": Model(staging.stg_league, ("raw_league",)),
    "stg_teams_info": Model(staging.stg_teams_info, ("raw_teams_info",)),
    "stg_team_statistics": Model(staging.stg_team_statistics, ("raw_teams_statistics",)),
    "stg_players_statistics": Model(staging.stg_players_statistics, ("raw_players_statistics",)),
    "stg_player_trophies": Model(staging.stg_player_trophies, ("raw_player_trophies",)),
    "stg_fixture_info": Model(staging.stg_fixture_info, ("raw_fixture_info",)),
    "stg_fixture_line_up": Model(staging.stg_fixture_line_up, ("raw_fixture_line_up",)),
    "stg_fixture_statistics": Model(staging.stg_fixture_statistics, ("raw_fixture_statistics",)),
    "stg_fixture_players_statistics": Model(
        staging.stg_fixture_players_statistics, ("raw_fixture_players_statistic",)
    ),
    "stg_fixture_predictions": Model(staging.stg_fixture_predictions, ("raw_fixture_predictions",)),
    "stg_football_manager": Model(staging.stg_football_manager, ("football_manager_raw",)),
    "stg_kafka_fixture_live_events": Model(staging.stg_kafka_fixture_live_events, ("kafka_fixture_live_events",)),
    "dim_fixture": Model(marts.dim_fixture, ("stg_fixture_info",), "table", True),
    "dim_league": Model(marts.dim_league, ("stg_league",), "table", True),
    "dim_player": Model(
        marts.dim_player, ("stg_players_statistics", "stg_fixture_players_statistics"), "table", True
    ),
    "dim_team": Model(marts.dim_team, ("stg_teams_info", "stg_fixture_info"), "table", True),
    "fct_football_manager": Model(marts.fct_football_manager, ("dim_player", "stg_football_manager"), "table"),
    "audit_manager_player_unmatched": Model(
        marts.audit_manager_player_unmatched, ("stg_football_manager", "dim_player")
    ),
    "fct_fixture_live_event": Model(
        marts.fct_fixture_live_event, ("stg_kafka_fixture_live_events",), "incremental"
    ),
    "fct_fixture_live_goal": Model(marts.fct_fixture_live_goal, ("fct_fixture_live_event",)),
    "fct_fixture_live_card": Model(marts.fct_fixture_live_card, ("fct_fixture_live_event",)),
    "fct_fixture_live_substitution": Model(marts.fct_fixture_live_substitution, ("fct_fixture_live_event",)),
}

# The models refreshed together. Predictions are in neither group.
GROUPS: dict[str, tuple[str, ...]] = {
    "live": (
        "stg_kafka_fixture_live_events",
        "fct_fixture_live_event",
        "fct_fixture_live_goal",
        "fct_fixture_live_card",
        "fct_fixture_live_substitution",
    ),
    "history": (
        "stg_league",
        "stg_teams_info",
        "stg_team_statistics",
        "stg_players_statistics",
        "stg_player_trophies",
        "stg_fixture_info",
        "stg_fixture_line_up",
        "stg_fixture_statistics",
        "stg_fixture_players_statistics",
        "stg_football_manager",
        "dim_fixture",
        "dim_league",
        "dim_player",
        "dim_team",
        "fct_football_manager",
        "audit_manager_player_unmatched",
    ),
}

EVENT_KEYS = ("topic", "partition", "offset")


def build(
    spark: SparkSession,
    names: tuple[str, ...],
    sources: Mapping[str, DataFrame],
    root: str | None = None,
    as_of: Column | None = None,
) -> dict[str, DataFrame]:
    """Build `names` and return them by name; every one is also a temporary view.

    With `root`, table models are written below it as a new version and read back, and the
    incremental fact takes in only unseen log offsets. Without it everything stays a view.
    """
    ready: dict[str, DataFrame] = dict(sources)
    out: dict[str, DataFrame] = {}
    for name in names:
        model = MODELS[name]
        extra = {"as_of": as_of} if model.stamped else {}
        df = model.build(*[ready[i] for i in model.inputs], **extra)
        if root and model.kind == "table":
            write_table(df, f"{root}/{name}")
            df = current_table(spark, f"{root}/{name}")
        elif root and model.kind == "incremental":
            merge_incremental(df, f"{root}/{name}", EVENT_KEYS, "offset")
            df = read_incremental(spark, f"{root}/{name}", df.schema, "offset")
        df.createOrReplaceTempView(name)
        ready[name] = out[name] = df
    return out


def run_group(
    spark: SparkSession,
    group: str,
    sources: Mapping[str, DataFrame],
    root: str | None = None,
    as_of: Column | None = None,
) -> dict[str, DataFrame]:
    """Build the `live` or the `history` models."""
    return build(spark, GROUPS[group], sources, root, as_of)
