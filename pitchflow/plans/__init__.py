"""The models: staging projections, marts, and the groups they are built in."""

from pitchflow.plans.marts import (
    audit_manager_player_unmatched,
    dim_fixture,
    dim_league,
    dim_player,
    dim_team,
    fct_fixture_live_card,
    fct_fixture_live_event,
    fct_fixture_live_goal,
    fct_fixture_live_substitution,
    fct_football_manager,
)
from pitchflow.plans.materialize import current_table, merge_incremental, read_incremental, write_table
from pitchflow.plans.models import GROUPS, MODELS, Model, build, run_group
from pitchflow.plans.staging import (
    stg_fixture_info,
    stg_fixture_line_up,
    stg_fixture_players_statistics,
    stg_fixture_predictions,
    stg_fixture_statistics,
    stg_football_manager,
    stg_kafka_fixture_live_events,
    stg_league,
    stg_player_trophies,
    stg_players_statistics,
    stg_team_statistics,
    stg_teams_info,
)

__all__ = [
    "GROUPS",
    "MODELS",
    "Model",
    "audit_manager_player_unmatched",
    "build",
    "current_table",
    "dim_fixture",
    "dim_league",
    "dim_player",
    "dim_team",
    "fct_fixture_live_card",
    "fct_fixture_live_event",
    "fct_fixture_live_goal",
    "fct_fixture_live_substitution",
    "fct_football_manager",
    "merge_incremental",
    "read_incremental",
    "run_group",
    "stg_fixture_info",
    "stg_fixture_line_up",
    "stg_fixture_players_statistics",
    "stg_fixture_predictions",
    "stg_fixture_statistics",
    "stg_football_manager",
    "stg_kafka_fixture_live_events",
    "stg_league",
    "stg_player_trophies",
    "stg_players_statistics",
    "stg_team_statistics",
    "stg_teams_info",
    "write_table",
]
