"""Stored layers, as a folder or a catalog table."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ticksmith.config import PipelineConfig
from ticksmith.schemas import BRONZE, GOLD, SILVER, TRANSFORMED
from ticksmith.sources.parts import read_candles

DATE_COLUMN = "trade_date"
# Readers of data files skip names that begin so.
_NOTES = "_columns"
SCHEMAS = {"bronze": BRONZE, "transformed": TRANSFORMED, "silver": SILVER, "gold": GOLD}


def read_layer(
    spark: SparkSession,
    cfg: PipelineConfig,
    layer: str,
    streaming: bool = True,
    schema: T.StructType | None = None,
    whole: bool = False,
) -> DataFrame:
    """Rows of a layer, all present ones first and then, in a stream, the new ones.

    Folders are read by column name with the declared columns and those that files have
    beside them: a column added later is NULL in older files. Stages note those columns beside
    the files; only where a folder has no such note, since it was filled from outside, are its
    files' footers merged. Pass ``schema`` to look at neither. In a date-partitioned layout the
    ``trade_date`` column comes last; filter on it to read only those days.

    Gold with ``late="revise"`` is read in batch only: its parts are merged into candles.

    ``whole`` takes up everything there is in one micro-batch, whatever the trigger size.
    Stages with a watermark need it: the files of a layer are not in time order, so a
    watermark that moves between them would drop the rows of all but the first.
    """
    target = cfg.target(layer)
    if layer == "gold" and cfg.late == "revise":
        if streaming:
            raise ValueError("candles that change cannot be read as a stream of rows")
        return read_candles(spark, target, cfg.fmt)
    reader = spark.readStream if streaming else spark.read
    if streaming and whole:
        if cfg.fmt == "delta":  # has a limit of its own
            reader = reader.option("maxFilesPerTrigger", str(2**31 - 1))
    elif streaming and cfg.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(cfg.max_files_per_trigger))
    if cfg.catalog is not None:
        return reader.table(target)
    if cfg.fmt != "delta":
        columns = schema or _grown(spark, cfg, layer)
        if cfg.partition_by_date:
            columns = T.StructType([*columns.fields, T.StructField(DATE_COLUMN, T.DateType())])
        reader = reader.schema(columns)
    return reader.format(cfg.fmt).load(target)


def _grown(spark: SparkSession, cfg: PipelineConfig, layer: str) -> T.StructType:
    """The declared columns and those that the layer has beside them."""
    declared = SCHEMAS[layer]
    stored = noted_columns(spark, cfg.target(layer))
    if stored is None:
        stored = _footers(spark, cfg, layer)
    known = {*declared.names, DATE_COLUMN}
    return T.StructType([*declared.fields, *(f for f in stored if f.name not in known)])


def _footers(spark: SparkSession, cfg: PipelineConfig, layer: str) -> list[T.StructField]:
    try:
        merged = spark.read.option("mergeSchema", "true").format(cfg.fmt).load(cfg.target(layer))
        return merged.schema.fields
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []


def noted_columns(spark: SparkSession, folder: str) -> list[T.StructField] | None:
    """The columns that writers of a folder have noted, in the order they came; None without a
    note. A note is a line of JSON per change, so that writers only ever add to it."""
    try:
        lines = spark.read.schema("value string").text(f"{folder}/{_NOTES}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if not lines:
        return None
    notes = sorted((json.loads(line["value"]) for line in lines), key=lambda note: note["turn"])
    fields: dict[str, T.StructField] = {}
    for note in notes:
        for field in T.StructType.fromJson(note["columns"]):
            fields.setdefault(field.name, field)
    return list(fields.values())


def columns_to_note(spark: SparkSession, folder: str, columns: T.StructType) -> str | None:
    """The note that a folder needs before it gets these columns, if any.

    A folder that holds files but no note was filled before there were notes or from outside: it
    is left without, and its readers go on merging footers.
    """
    known = noted_columns(spark, folder)
    if known is None and has_files(spark, folder):
        return None
    names = {field.name for field in known or ()}
    new = [field for field in columns if field.name not in names]
    if not new and known is not None:
        return None
    return json.dumps({"turn": len(names), "columns": T.StructType(new).jsonValue()})


def note_columns(spark: SparkSession, folder: str, note: str) -> None:
    line = spark.createDataFrame([(note,)], "value string").coalesce(1)
    line.write.mode("append").text(f"{folder}/{_NOTES}")


def has_files(spark: SparkSession, folder: str) -> bool:
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        return not found.select("path").limit(1).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
