"""Every operator and model bound to the star-schema, event and document tables, with its SQL twin."""

from pitchflow.bindings import generic, landing, models, quality, streams  # noqa: F401  (they register)
from pitchflow.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
