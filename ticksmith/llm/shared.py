"""Helpers of the operators: written intermediate tables, row keys, words of Arrow text."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
#: Text bytes worked on at a time; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words split at ASCII white space, and of words of digits, letters and non-ASCII.
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower case for A-Z alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one that driver and executors share.

    It is the session's ``spark.checkpoint.dir``; a folder of this machine stands in for it in
    local mode only.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="ticksmith-llm-")
    return f"{folder.rstrip('/')}/llm/{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table written once to the shared folder: it cuts the lineage, is not
    computed again, and outlives lost executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def row_key(identity: str, text: str) -> list[Column]:
    """88 bits of hashes that name a row by its id and text; rows equal in both share them."""
    key, body = F.col(f"`{identity}`"), F.col(f"`{text}`")
    more = F.xxhash64(key, F.lit(1), body).bitwiseAND(F.lit((1 << 24) - 1)).cast("int")
    return [F.xxhash64(key, body).alias("_k1"), more.alias("_k2")]


def require(frame: DataFrame, *names: str) -> None:
    """Refuse a frame that lacks a column, or holds one of the operators' own names."""
    lower = [c.lower() for c in frame.columns]
    for name in names:
        if lower.count(name.lower()) != 1:
            raise ValueError(f"one column {name} is needed, there are {lower.count(name.lower())}")


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string (UTF-8) or binary column and each row's offsets in them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    if column.type not in (pa.large_string(), pa.large_binary()):
        column = column.cast(kind)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = int(offsets[0]) if len(offsets) else 0
    end = int(offsets[-1]) if len(offsets) else 0
    return data[start:end], offsets - start


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes together, never none."""
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes of a kind, and each row's first run.

    Runs end with their row. ``data`` must already be in the wanted case.
    """
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before &= ~edge[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after &= ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes over the whole word."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def powers(count: int) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64."""
    table = np.full(max(count, 1), _BASE, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, leading: int | None = None
) -> np.ndarray:
    """A 64-bit hash of every word, or of its leading bytes."""
    lengths = ends - starts
    if leading is not None:
        lengths = np.minimum(lengths, leading)
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    source = np.repeat(starts, lengths) + within
    values = (data[source].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[within]
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbouring values, by doubling and, where ``width`` is no power
    of two, of two that overlap."""
    values = mixed(values.astype(np.uint64) + np.uint64(1))
    step, factor = 1, _BASE
    while step < width:
        more = min(step, width - step)
        values = values[:-more] * factor + values[more:] if len(values) > more else values[:0]
        step, factor = step + more, np.uint64(int(factor) * int(factor) & (2**64 - 1))
    return mixed(values)


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)


def clashing(frame: DataFrame, names: list[str]) -> DataFrame:
    """The frame without columns whose names the result needs, whatever their case."""
    taken = {n.lower() for n in names}
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c.lower() not in taken])
