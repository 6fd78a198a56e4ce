"""Working folders of the streaming queries."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def run_folder(spark: SparkSession) -> str:
    """A new folder under the shared one the session names.

    A folder of this machine stands in for it in local mode only, where every task sees it.
    """
    shared = spark.conf.get(_SETTING, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="ticksmith-")
        spark.conf.set(_SETTING, shared)
    return f"{shared.rstrip('/')}/ticksmith/{uuid.uuid4().hex}"
