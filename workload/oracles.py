"""DuckDB SQL giving each query's result, from the same tables and the feed rules."""

from __future__ import annotations

# Feed E: one row per event, and a copy of some. epoch_ms would round to the next millisecond.
_FEED = """
feed AS (
  SELECT e.event_id + c.n * 1000000000 AS arrival,
         CAST(e.user_id % 50 AS VARCHAR) AS conditions,
         (CASE WHEN (c.n = 0 AND e.event_id % 89 = 0) OR (c.n = 1 AND e.event_id % 291 = 0)
               THEN -e.value ELSE e.value END) + c.n AS price,
         CASE WHEN e.event_id % 101 <> 0 THEN e.event_type END AS symbol,
         epoch_us(e.ts) // 1000 AS timestamp,
         CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS volume
  FROM events e, (VALUES (0), (1)) c(n)
  WHERE c.n = 0 OR e.event_id % 97 = 0 OR e.event_id % 89 = 0
)"""

# Feed M: one to three fills per trade.
_FILLS = """
fills AS (
  SELECT arrival * 10 AS message_id, n AS position, conditions, price + n AS price, symbol,
         timestamp + n AS timestamp, volume, arrival >= 1000000000 AS copied
  FROM (SELECT *, unnest(range(0, arrival % 1000000000 % 3 + 1)) AS n FROM feed)
)"""

_LINEITEM = """
feed AS (
  SELECT l_orderkey * 8 + l_linenumber AS arrival,
         l_extendedprice / l_quantity AS price,
         CAST(l_partkey AS VARCHAR) AS symbol,
         epoch_us(l_shipdate) // 1000 AS timestamp,
         l_quantity AS volume
  FROM lineitem
)"""

_EXTRAS = """
extras AS (
  SELECT e.event_id * 10 + x.kind AS message_id, x.value, x.reason
  FROM events e, (VALUES (1, 83, '{"type":"ping"}', 'no_data'),
                         (2, 79, '{"type":"trade","data":[{"c":[1],"p":10', 'malformed'),
                         (3, 73, '{"type":"trade","data":[]}', 'empty'),
                         (4, 71, NULL, 'null')) x(kind, every, value, reason)
  WHERE e.event_id % x.every = 0
)"""

_TIME = "make_timestamp((timestamp // 1000) * 1000000)"


def _clean(source: str, order: str, mode: str = "dedup_first") -> str:
    good = "price > 0 AND symbol IS NOT NULL"
    before, after = ("TRUE", good) if mode == "dedup_first" else (good, "TRUE")
    return f"""
clean AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY {order}) AS nth
    FROM {source} WHERE {before}
  ) WHERE nth = 1 AND {after}
)"""


def _candles(source: str, start: str) -> str:
    return f"""
SELECT symbol, {start} AS candle_time,
       arg_min(price, timestamp) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, timestamp) AS close, sum(volume) AS volume
FROM {source} GROUP BY 1, 2"""


def _closed(source: str, unit: str, delay: str) -> str:
    """Candles whose window the watermark has reached."""
    return f"""
SELECT * FROM ({_candles(source, f"date_trunc('{unit}', {_TIME})")})
WHERE candle_time + INTERVAL 1 {unit}
      <= (SELECT max({_TIME}) FROM {source}) - INTERVAL {delay}"""


def _trunc(unit: str) -> str:
    # date_trunc gives a DATE for days.
    return f"CAST(date_trunc('{unit}', {_TIME}) AS TIMESTAMP)"


_TRADE_COLUMNS = "arrival, conditions, price, symbol, timestamp, volume"
_STORED_COLUMNS = "conditions, price, symbol, timestamp, volume"
_TIMED_COLUMNS = (
    f"{_STORED_COLUMNS}, strftime({_TIME}, '%Y-%m-%d %H:%M:%S') AS time_stamp, {_TIME} AS time"
)
_FEED_CLEAN = _FEED + "," + _clean("feed", "arrival")
_ORIGINALS = _FEED + ", originals AS (SELECT * FROM feed WHERE arrival < 1000000000)"
_FILLS_CLEAN = _FEED + "," + _FILLS + "," + _clean("fills", "message_id, position")
_NEW_FILLS_CLEAN = (
    f"{_FEED},{_FILLS}, new_fills AS (SELECT * FROM fills WHERE NOT copied),"
    + _clean("new_fills", "message_id, position")
)

# Rows of the second run are counted only if the first run's watermark left their window open.
_LATE = (
    _ORIGINALS
    + f""",
middle AS (SELECT (min(timestamp) + max(timestamp)) // 2 AS at FROM originals),
first_run AS (SELECT o.* FROM originals o, middle WHERE timestamp < middle.at),
second_run AS (
  SELECT o.* FROM originals o, middle WHERE timestamp >= middle.at
  UNION ALL
  SELECT arrival, conditions, price, symbol, timestamp + 1, volume
  FROM feed WHERE arrival >= 1000000000
),
seen AS (
  SELECT * FROM first_run
  UNION ALL
  SELECT * FROM second_run
  WHERE date_trunc('hour', {_TIME}) + INTERVAL 1 hour
        > (SELECT max({_TIME}) FROM first_run) - INTERVAL 2 minute
)"""
)

_REVISED = f"""
WITH {_ORIGINALS},
every_trade AS (
  SELECT arrival, price, symbol, timestamp, volume FROM originals
  UNION ALL
  SELECT arrival, price, symbol, timestamp + 1, volume FROM feed WHERE arrival >= 1000000000
)
{_candles("every_trade", f"date_trunc('hour', {_TIME})")}"""

ORACLES: dict[str, str] = {
    "route_trade_messages": f"""
WITH {_FEED},{_EXTRAS}
SELECT arrival * 10 AS message_id, price AS first_price FROM feed
UNION ALL
SELECT message_id, CAST(NULL AS DOUBLE) AS first_price FROM extras WHERE reason = 'empty'""",
    "parse_trades": f"""
WITH {_FEED},{_FILLS}
SELECT message_id, CAST(position AS INTEGER) AS position, {_STORED_COLUMNS} FROM fills""",
    "rejected_messages": f"WITH {_EXTRAS} SELECT message_id, value, reason FROM extras",
    "message_round_trip": f"WITH {_FEED} SELECT {_STORED_COLUMNS} FROM feed",
    "event_time": f"""
WITH {_FEED}
SELECT arrival, timestamp, strftime({_TIME}, '%Y-%m-%d %H:%M:%S') AS time_stamp, {_TIME} AS time
FROM feed""",
    "event_time_ms": f"""
WITH {_FEED} SELECT arrival, timestamp, make_timestamp(timestamp * 1000) AS time FROM feed""",
    "filter_symbols": f"""
WITH {_FEED} SELECT {_TRADE_COLUMNS} FROM feed WHERE symbol IN ('click', 'purchase')""",
    "clean_dedup_first": f"WITH {_FEED_CLEAN} SELECT {_TRADE_COLUMNS} FROM clean",
    "clean_filter_first": f"""
WITH {_FEED},{_clean("feed", "arrival", "filter_first")} SELECT {_TRADE_COLUMNS} FROM clean""",
    "clean_lineitem": f"""
WITH {_LINEITEM},{_clean("feed", "arrival")}
SELECT arrival, price, symbol, timestamp, volume FROM clean""",
    "candles_1m": f"WITH {_FEED_CLEAN} {_candles('clean', _trunc('minute'))}",
    "candles_1h": f"WITH {_FEED_CLEAN} {_candles('clean', _trunc('hour'))}",
    "candles_1d": f"WITH {_FEED_CLEAN} {_candles('clean', _trunc('day'))}",
    "candles_lineitem_30d": f"""
WITH {_LINEITEM},{_clean("feed", "arrival")}
{_candles("clean", f"time_bucket(INTERVAL 30 day, {_TIME}, TIMESTAMP '1970-01-01')")}""",
    "candles_arrival": f"""
WITH {_FEED_CLEAN}
SELECT symbol, candle_time, high, low, volume,
       open BETWEEN low AND high AS open_inside, close BETWEEN low AND high AS close_inside
FROM ({_candles("clean", _trunc("hour"))})""",
    "candles_from_messages": f"WITH {_FILLS_CLEAN} {_candles('clean', _trunc('hour'))}",
    "stream_candles_closed": f"WITH {_ORIGINALS} {_closed('originals', 'minute', '2 minute')}",
    "stream_late_drop": f"WITH {_LATE} {_closed('seen', 'hour', '2 minute')}",
    # The far trade closes all windows of its symbol's first run; those of its second are late.
    "stream_symbol_clock": f"""
WITH {_ORIGINALS},
middle AS (SELECT (min(timestamp) + max(timestamp)) // 2 AS at FROM originals),
seen AS (SELECT o.* FROM originals o, middle WHERE symbol IS DISTINCT FROM 'click' OR timestamp < middle.at),
clocks AS (
  SELECT symbol AS ticker, CASE WHEN symbol IS DISTINCT FROM 'click' THEN max({_TIME})
                                ELSE max({_TIME}) + INTERVAL 10 year END AS clock
  FROM originals GROUP BY symbol
)
SELECT c.* FROM ({_candles('seen', _trunc('hour'))}) c
JOIN clocks ON c.symbol IS NOT DISTINCT FROM ticker
WHERE candle_time + INTERVAL 1 hour <= clock - INTERVAL 2 minute""",
    "stream_late_revised": _REVISED,
    "stream_late_revised_compacted": _REVISED,
    "stream_incremental": f"WITH {_FEED_CLEAN} {_closed('clean', 'hour', '2 minute')}",
    "stream_clean": f"WITH {_FEED_CLEAN} SELECT {_TIMED_COLUMNS} FROM clean",
    "stream_clean_bounded": f"""
WITH {_FEED},
mark AS (
  SELECT max({_TIME}) - INTERVAL 2 day AS at FROM feed
  WHERE arrival < 1000000000 AND symbol IS NOT NULL AND price > 0
),
timely AS (SELECT feed.* FROM feed, mark WHERE arrival < 1000000000 OR {_TIME} > mark.at),
{_clean("timely", "arrival", "filter_first")} SELECT {_TIMED_COLUMNS} FROM clean""",
    "stream_clean_uncollapsed": f"WITH {_FEED_CLEAN} SELECT {_TIMED_COLUMNS} FROM clean",
    "stream_clean_filter_first": f"""
WITH {_FEED},{_clean("feed", "arrival", "filter_first")} SELECT {_TIMED_COLUMNS} FROM clean""",
    "stream_clean_first_arrival": f"WITH {_FEED_CLEAN} SELECT {_TIMED_COLUMNS}, arrival FROM clean",
    "stream_clean_first_arrival_bounded": f"WITH {_FEED_CLEAN} SELECT {_TIMED_COLUMNS}, arrival FROM clean",
    "chained_candles": f"WITH {_NEW_FILLS_CLEAN} {_closed('clean', 'hour', '10 minute')}",
    "chained_candles_unbounded": f"WITH {_NEW_FILLS_CLEAN} {_closed('clean', 'hour', '2 minute')}",
    "layered_bronze": f"WITH {_FEED},{_FILLS} SELECT {_STORED_COLUMNS} FROM fills",
    "layered_transformed": f"WITH {_FEED},{_FILLS} SELECT {_TIMED_COLUMNS} FROM fills",
    "layered_silver": f"WITH {_FILLS_CLEAN} SELECT {_TIMED_COLUMNS} FROM clean",
    "layered_gold": f"WITH {_FILLS_CLEAN} {_closed('clean', 'minute', '2 minute')}",
    "layered_gold_small_triggers": f"WITH {_FILLS_CLEAN} {_closed('clean', 'minute', '2 minute')}",
    "layered_gold_landed": f"WITH {_FILLS_CLEAN} {_closed('clean', 'minute', '2 minute')}",
    "candles_fractional": f"""
WITH {_FEED},
untimed AS (
  SELECT * REPLACE (CASE WHEN arrival % 103 <> 0 THEN timestamp END AS timestamp, volume / 7 AS volume)
  FROM feed
),{_clean("untimed", "arrival")},
timed AS (SELECT * FROM clean WHERE timestamp IS NOT NULL)
SELECT * REPLACE (round(volume, 6) AS volume) FROM ({_candles("timed", _trunc("hour"))})""",
    "candles_many_splits": f"""
WITH {_FEED},{_FILLS},
placed AS (
  SELECT *, (message_id % 1500) * 8589934592 + message_id
            + CASE WHEN copied THEN 4611686018427387904 ELSE -2305843009213693952 END AS place
  FROM fills
),{_clean("placed", "place, position")}
{_candles("clean", _trunc("hour"))}""",
    "schema_evolution": f"""
WITH {_FILLS_CLEAN}
SELECT {_TIMED_COLUMNS}, CASE WHEN copied THEN 'venue-' || symbol END AS venue FROM clean""",
    "progress_many_batches": f"""
WITH {_FEED} SELECT count(*) AS input_rows, TRUE AS many_batches FROM feed""",
    "progress_delivery": f"""
WITH {_FILLS_CLEAN},{_EXTRAS},
messages AS (SELECT count(*) AS n FROM feed),
counted AS (
  SELECT 'ingest' AS stage, 'messages' AS observed, 'read' AS measure,
         (SELECT n FROM messages) + (SELECT count(*) FROM extras) AS rows
  UNION ALL SELECT 'ingest', 'messages', 'accepted', n FROM messages
  UNION ALL SELECT 'ingest', 'messages', 'rejected_' || r.reason,
                   (SELECT count(*) FROM extras e WHERE e.reason = r.reason)
            FROM (VALUES ('null'), ('malformed'), ('no_data'), ('empty')) r(reason)
  UNION ALL SELECT s.stage, 'written', 'rows', (SELECT count(*) FROM fills)
            FROM (VALUES ('ingest'), ('transform')) s(stage)
  UNION ALL SELECT 'clean', 'written', 'rows', (SELECT count(*) FROM clean)
  UNION ALL SELECT s.stage, 'trades', m.measure,
                   (SELECT count(*) FROM fills
                    WHERE CASE m.measure WHEN 'no_symbol' THEN symbol IS NULL
                                         WHEN 'bad_price' THEN symbol IS NOT NULL AND price <= 0
                                         ELSE TRUE END)
            FROM (VALUES ('transform'), ('clean')) s(stage),
                 (VALUES ('read'), ('no_symbol'), ('bad_price')) m(measure)
)
SELECT * FROM counted""",
    # A key lives for two days from its first trade; late trades of the second run are not taken.
    "stream_state_keys": f"""
WITH {_FEED},
good AS (SELECT *, {_TIME} AS time FROM feed WHERE symbol IS NOT NULL AND price > 0),
mark AS (SELECT max(time) - INTERVAL 2 day AS at FROM good WHERE arrival < 1000000000),
taken AS (SELECT good.* FROM good, mark WHERE arrival < 1000000000 OR time > mark.at),
last AS (SELECT max(time) - INTERVAL 2 day AS at FROM taken)
SELECT symbol, timestamp, {_TIME} + INTERVAL 2 day AS until
FROM (SELECT DISTINCT symbol, timestamp FROM taken), last
WHERE {_TIME} + INTERVAL 2 day > last.at""",
    "progress": f"""
WITH {_FEED},
keys AS (SELECT DISTINCT symbol, timestamp FROM feed WHERE symbol IS NOT NULL)
SELECT (SELECT count(*) FROM events) AS input_rows,
       (SELECT count(*) FROM keys) AS state_rows,
       (SELECT count(*) FROM keys) AS state_rows_written,
       CAST(0 AS BIGINT) AS late_rows_dropped""",
}
