"""Continuous loads: log to RAW, RAW to fact, and polls to new live events."""

from pitchflow.streaming.landing import log_to_raw_rows, stream_to_fact, stream_to_raw
from pitchflow.streaming.live import (
    emit_new_events,
    live_messages,
    new_events,
    next_cursor,
)
from pitchflow.streaming.rounds import PollRounds, keep_running, publish_rounds, rounds_emitted, unseen_events

__all__ = [
    "PollRounds",
    "emit_new_events",
    "keep_running",
    "live_messages",
    "log_to_raw_rows",
    "new_events",
    "next_cursor",
    "publish_rounds",
    "rounds_emitted",
    "stream_to_fact",
    "stream_to_raw",
    "unseen_events",
]
