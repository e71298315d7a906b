"""Relational operators: DataFrames in, DataFrames out, nothing collected."""

from pitchflow.operators.dedup import distinct_by, first_n_by, group_max, latest_by
from pitchflow.operators.flatten import flatten
from pitchflow.operators.grouping import batch_keys, collect_nested, compose_payload, rank_within, sorted_set
from pitchflow.operators.incremental import not_in, unseen, upsert
from pitchflow.operators.joins import lookup, match_latest, spread_join, unmatched
from pitchflow.operators.pivot import pivot_max, rank_pivot
from pitchflow.operators.union import union_padded, unpivot_sides
from pitchflow.operators.work import active_entities, live_today, pending_work

__all__ = [
    "active_entities",
    "batch_keys",
    "collect_nested",
    "compose_payload",
    "distinct_by",
    "first_n_by",
    "flatten",
    "group_max",
    "latest_by",
    "live_today",
    "lookup",
    "match_latest",
    "not_in",
    "pending_work",
    "pivot_max",
    "rank_pivot",
    "rank_within",
    "sorted_set",
    "spread_join",
    "union_padded",
    "unmatched",
    "unpivot_sides",
    "unseen",
    "upsert",
]
