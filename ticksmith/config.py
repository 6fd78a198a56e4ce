"""Settings of one layered run. Nothing is read from the environment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The accepted environment and space names, and the table of each layer.
ENVIRONMENTS = ("dev", "test", "prod")
SPACES = ("feature", "qa", "synthetic", "actual", "release")
TABLES = {
    "bronze": "kafka_ingest_data",
    "transformed": "transformed_stock_data",
    "silver": "cleaned_stock_data",
    "gold": "trades_stock_data",
}

_FOLDERS = {"bronze": "bronze", "transformed": "bronze", "silver": "silver", "gold": "gold"}


@dataclass(frozen=True)
class PipelineConfig:
    """Where the layers live and how each stage behaves.

    Layers are folders under ``base_path`` or, with ``catalog`` set, catalog tables;
    checkpoints always live under ``base_path``, which every executor must reach.
    """

    base_path: str
    env: str = "dev"
    space: str = "feature"
    fmt: str = "parquet"
    catalog: str | None = None

    source_format: str = "kafka"
    source_options: Mapping[str, str] = field(default_factory=dict)
    # What `land` reads, and how it writes the topic if that takes other options than reading.
    raw_format: str = "kafka"
    raw_options: Mapping[str, str] = field(default_factory=dict)
    topic_options: Mapping[str, str] = field(default_factory=dict)
    max_files_per_trigger: int | None = None
    partition_by_date: bool = False

    symbols: tuple[str, ...] = ()
    precision: str = "s"
    clean_mode: str = "dedup_first"
    dedup_within: str | None = None
    # Columns of the transformed layer that order the rows of a key within a micro-batch.
    arrival: tuple[str, ...] = ()
    collapse_copies: bool = True
    candle_width: str = "1 minute"
    watermark: str = "2 minutes"
    order: str = "event_time"
    # Whose trades close a candle: those of the whole "stream", or of its own "symbol".
    clock: str = "stream"
    # Trades of windows already written: "drop" them, or "revise" the candle.
    late: str = "drop"
    # Count what the messages and trades of every micro-batch hold, for `delivery_report`.
    count_content: bool = False

    state_partitions: int | None = None
    state_provider: str | None = "rocksdb"
    count_state_rows: bool = False
    timeout_seconds: int | None = None

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"env must be one of {ENVIRONMENTS}, got {self.env!r}")
        if self.clock not in ("stream", "symbol"):
            raise ValueError(f"clock must be 'stream' or 'symbol', got {self.clock!r}")
        if self.late not in ("drop", "revise"):
            raise ValueError(f"late must be 'drop' or 'revise', got {self.late!r}")
        if self.late == "revise":
            self._check_revised()
        if self.space not in SPACES:
            raise ValueError(f"space must be one of {SPACES}, got {self.space!r}")

    def _check_revised(self) -> None:
        """Candles that change are kept in parts, which only folders of plain files hold."""
        if self.catalog is not None or self.fmt == "delta" or self.partition_by_date:
            raise ValueError("late='revise' needs folders of plain files, without a catalog or days")
        if self.clock != "stream" or self.order != "event_time":
            raise ValueError("late='revise' closes no window and takes open and close by event time")

    @property
    def root(self) -> str:
        return f"{self.base_path.rstrip('/')}/{self.env}/{self.space}"

    def target(self, layer: str) -> str:
        """Folder of a layer, or its ``catalog.schema.table`` name in catalog mode."""
        table = TABLES[layer]
        if self.catalog is None:
            return f"{self.root}/{_FOLDERS[layer]}/{table}"
        return f"{self.catalog}.{self.env}_{self.space}_{_FOLDERS[layer]}.{table}"

    def checkpoint(self, stage: str) -> str:
        """Checkpoint folder of a stage; no two stages or environments share one."""
        return f"{self.root}/checkpoints/{stage}"
