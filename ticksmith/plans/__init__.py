"""Whole dataflows: the four chained stages, one chained query, and the batch twin."""

from ticksmith.plans.direct import batch_candles, chained_candles
from ticksmith.plans.layered import LAND, STAGES, chain, run, run_stage

__all__ = ["LAND", "STAGES", "batch_candles", "chain", "chained_candles", "run", "run_stage"]
