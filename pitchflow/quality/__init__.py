"""Declared data-quality checks and their report."""

from pitchflow.quality.checks import (
    Check,
    accepted_range,
    expression_is_true,
    failing_rows,
    not_null,
    relationships,
    run_checks,
    unique_combination,
)
from pitchflow.quality.specs import CHECKS
from pitchflow.quality.states import CheckStates, check_states

__all__ = [
    "CHECKS",
    "Check",
    "CheckStates",
    "accepted_range",
    "check_states",
    "expression_is_true",
    "failing_rows",
    "not_null",
    "relationships",
    "run_checks",
    "unique_combination",
]
