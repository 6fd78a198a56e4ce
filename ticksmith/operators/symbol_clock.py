"""Candles of a stream in which every symbol has a clock of its own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ticksmith.schemas import GOLD

_PART = (
    "symbol string, start bigint, clock bigint, open_at bigint, open double, high double, low double, "
    "close_at bigint, close double, volume double"
)
_OPEN = (
    "start bigint, open_at bigint, open double, high double, low double, close_at bigint, close double, "
    "volume double"
)
_CANDLE = "symbol string, start bigint, open double, high double, low double, close double, volume double"


def symbol_clock_candles(trades: DataFrame, width: str = "1 minute", delay: str = "2 minutes") -> DataFrame:
    """OHLCV per symbol and tumbling window of ``time``, closed by the symbol's own trades.

    A candle is emitted once, when the latest trade of its symbol is ``delay`` past the window's
    end, and trades of windows already closed are dropped. So a trade dated far in the future
    closes the windows of its symbol alone, and a busy symbol never makes a quiet one's trades
    late. Windows that a symbol's later trades do not close stay in state.

    Every Arrow batch is summed to a row per symbol and window before the shuffle, so a symbol
    with a third of all trades sends its task a few rows per batch.
    """
    width_ms, delay_ms = (int(pd.Timedelta(text).total_seconds() * 1000) for text in (width, delay))
    timed = trades.where(F.col("time").isNotNull())
    parts = timed.select("symbol", F.unix_millis("time").alias("at"), "timestamp", "price", "volume")
    parts = parts.mapInArrow(_summed(width_ms), _PART)
    closed = parts.groupBy("symbol").transformWithState(
        _Clock(width_ms, delay_ms), outputStructType=_CANDLE, outputMode="Append", timeMode="None"
    )
    return closed.withColumn("candle_time", F.timestamp_millis("start")).select(*GOLD.names)


def _summed(width: int):
    """Parts of candles, a row per symbol and window of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("symbol").dictionary_encode()
            symbol = names.indices.fill_null(len(names.dictionary)).to_numpy(zero_copy_only=False)
            at, when = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "timestamp"))
            start = at - at % width
            order = np.lexsort((when, start, symbol))
            symbol, start, at, when = symbol[order], start[order], at[order], when[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (symbol[1:] != symbol[:-1]) | (start[1:] != start[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(order)) - 1
            # NaN is the largest price; a window without any volume has none.
            price = batch.column("price").to_numpy(zero_copy_only=False)[order]
            there = batch.column("volume").is_valid().to_numpy(zero_copy_only=False)[order]
            volume = np.where(there, batch.column("volume").to_numpy(zero_copy_only=False)[order], 0.0)
            none = np.add.reduceat(there.astype(np.int64), first) == 0
            yield pa.RecordBatch.from_arrays(
                [
                    names.dictionary.take(pa.array(symbol[first], mask=symbol[first] == len(names.dictionary))),
                    pa.array(start[first]), pa.array(np.maximum.reduceat(at, first)),
                    pa.array(when[first]), pa.array(price[first]), pa.array(np.maximum.reduceat(price, first)),
                    pa.array(np.fmin.reduceat(price, first)), pa.array(when[last]), pa.array(price[last]),
                    pa.array(np.add.reduceat(volume, first), mask=none),
                ],
                ["symbol", "start", "clock", "open_at", "open", "high", "low", "close_at", "close", "volume"],
            )

    return run


def _larger(a: float, b: float) -> float:
    return a if a != a or a >= b else b


def _smaller(a: float, b: float) -> float:
    return a if b != b or a <= b else b


class _Clock(StatefulProcessor):
    def __init__(self, width: int, delay: int):
        self.width, self.delay = width, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("candles", f"clock bigint, windows array<struct<{_OPEN}>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        clock, windows = None, {}
        if self.state.exists():
            clock, held = self.state.get()
            windows = {w["start"]: [w[c] for c in range(1, 8)] for w in held}
        # What the clock of earlier micro-batches has closed is closed; the order of rows
        # within this one does not matter.
        closed = None if clock is None else clock - self.delay
        for row in rows:
            clock = row["clock"] if clock is None else max(clock, row["clock"])
            if closed is not None and row["start"] + self.width <= closed:
                continue
            own = [row[c] for c in range(3, 10)]
            held = windows.get(row["start"])
            windows[row["start"]] = own if held is None else _merged(held, own)
        now = clock - self.delay
        done = sorted(s for s in windows if s + self.width <= now)
        for start in done:
            _, opening, high, low, _, closing, volume = windows.pop(start)
            yield Row(symbol=key[0], start=start, open=opening, high=high, low=low, close=closing, volume=volume)
        self.state.update((clock, [(s, *windows[s]) for s in sorted(windows)]))

    def close(self) -> None:
        pass


def _merged(a: list, b: list) -> list:
    opening = a[:2] if a[0] <= b[0] else b[:2]
    closing = a[4:6] if a[4] >= b[4] else b[4:6]
    volumes = [v for v in (a[6], b[6]) if v is not None]
    return [*opening, _larger(a[2], b[2]), _smaller(a[3], b[3]), *closing, sum(volumes) if volumes else None]
