"""First arrival per key in a stream, inside a micro-batch as well as across them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keys whose timestamps fall into the same span share a state entry and a call.
SPAN_MILLIS = 60_000
_SPAN = "_span"


def first_arrivals(
    trades: DataFrame, arrival: Sequence[str], within: str | None = None
) -> DataFrame:
    """The row of the least ``arrival`` of each (symbol, timestamp) of a stream.

    Within a micro-batch the arrival columns decide, NULL first; of several micro-batches the
    earliest wins, since its row is out already. State holds the timestamps seen per symbol and
    minute. Without ``within`` it grows with the keys; with it, a watermark on ``time`` drops
    later rows and clears the minutes behind it.
    """
    named = trades.withColumn(_SPAN, F.call_function("div", F.col("timestamp"), F.lit(SPAN_MILLIS)))
    if within is not None:
        named = named.withWatermark("time", within)
    found = named.groupBy("symbol", _SPAN).transformWithState(
        _FirstArrival(list(arrival), within is not None),
        outputStructType=trades.schema,
        outputMode="Append",
        timeMode="EventTime" if within is not None else "None",
    )
    return found.select(*trades.columns)


class _FirstArrival(StatefulProcessor):
    def __init__(self, arrival: list[str], bounded: bool):
        self.arrival, self.bounded = arrival, bounded

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "untimed boolean, timestamps array<bigint>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        late = timerValues.getCurrentWatermarkInMs() if self.bounded else None
        first: dict = {}
        for row in rows:
            if late is not None and row["time"] is not None and _millis(row["time"]) < late:
                continue
            order = [(row[c] is not None, row[c]) for c in self.arrival]
            held = first.get(row["timestamp"])
            if held is None or order < held[0]:
                first[row["timestamp"]] = (order, row)
        untimed, known = self.seen.get() if self.seen.exists() else (False, [])
        passed = set(known) | ({None} if untimed else set())
        fresh = [t for t in first if t not in passed]
        if not fresh:
            return
        if self.bounded and None not in fresh and not known:
            # A span is behind the watermark as soon as its end is.
            self.handle.registerTimer((key[1] + 1) * SPAN_MILLIS)
        if not self.bounded or None not in fresh:
            times = sorted([*known, *(t for t in fresh if t is not None)])
            self.seen.update((untimed or None in fresh, times))
        for t in fresh:
            row = first[t][1]
            yield Row(**{c: row[c] for c in row.__fields__ if c != _SPAN})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def _millis(moment) -> int:
    return int(moment.timestamp() * 1000)
