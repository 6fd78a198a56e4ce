"""Readers of messages and of stored layers."""

from ticksmith.sources.layers import DATE_COLUMN, read_layer
from ticksmith.sources.messages import kafka_options, read_messages

__all__ = ["DATE_COLUMN", "kafka_options", "read_layer", "read_messages"]
