"""Message sources: Kafka, or files holding the same ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ticksmith.schemas import MESSAGE

_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def kafka_options(
    servers: str,
    topic: str,
    username: str | None = None,
    password: str | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    login_module: str = _LOGIN_MODULE,
) -> dict[str, str]:
    """Options for reading one topic, over SASL/PLAIN when a user name is given.

    ``login_module`` differs on runtimes that ship a shaded Kafka client.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if username is not None:
        credentials = f"username={_quoted(username)} password={_quoted(password or '')}"
        options["kafka.security.protocol"] = "SASL_SSL"
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = f"{login_module} required {credentials};"
    return options


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages with at least a ``value`` column, as a stream or a batch.

    Kafka brings its own columns; a file source (its folder in the ``path`` option) is
    read with the declared message schema.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema("value string" if fmt == "text" else MESSAGE)
    return reader.load()


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'
