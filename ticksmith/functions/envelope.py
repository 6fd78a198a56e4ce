"""Expressions over the raw JSON message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticksmith.schemas import ENVELOPE


def envelope_trades(value: Column) -> Column:
    """The ``data`` array of a message, NULL where the text has none."""
    return F.from_json(value.cast("string"), ENVELOPE)["data"]


def message_type(value: Column) -> Column:
    """Top-level ``type`` of a message, NULL where the text is not a JSON object.

    ``from_json`` rather than ``get_json_object``: the latter loses messages that hold
    a NaN number and takes the first of a repeated key instead of the last.
    """
    options = {"allowSingleQuotes": "false"}
    return F.from_json(value.cast("string"), "type string", options)["type"]


def reject_reason(value: Column) -> Column:
    """Why a message yields no trade: ``null``, ``malformed``, ``no_data`` or ``empty``."""
    return (
        F.when(value.isNull(), F.lit("null"))
        .when(F.try_parse_json(value.cast("string")).isNull(), F.lit("malformed"))
        .when(envelope_trades(value).isNull(), F.lit("no_data"))
        .otherwise(F.lit("empty"))
    )
