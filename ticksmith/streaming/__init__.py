"""Checkpointed sinks, their state settings, their progress and their state."""

from ticksmith.streaming.parts import add_parts_available_now, compact_parts
from ticksmith.streaming.progress import delivery_report, progress_report
from ticksmith.streaming.settings import state_settings
from ticksmith.streaming.sinks import append_available_now, write_messages
from ticksmith.streaming.stored_state import keys_in_state

__all__ = [
    "add_parts_available_now",
    "append_available_now",
    "compact_parts",
    "delivery_report",
    "keys_in_state",
    "progress_report",
    "state_settings",
    "write_messages",
]
