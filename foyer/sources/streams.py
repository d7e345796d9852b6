"""Streaming sources: Kafka and socket lines, and the options of a Kafka consumer."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

#: Older than any file: no file is left out for its age.
ANY_AGE = "36500d"

# Keys of the properties file.
CONSUMER_PREFIX = "kafka.newConsumer."
BROKERS_KEY = "kafka.broker.bootstrap.servers"

# Settings Spark manages itself and refuses, or that its checkpoint replaces.
_MANAGED = {
    "group.id", "enable.auto.commit", "auto.offset.reset", "key.deserializer", "value.deserializer",
}


def parse_properties(lines: Iterable[str]) -> dict[str, str]:
    """A properties file: keys and values parted by ``=``, ``:`` or white space.

    Blank lines and those that begin with ``#`` or ``!`` are skipped; a backslash at a line's end
    continues it, and one before another sign takes that sign as it is, or as the sign it stands for.
    """
    found, held = {}, ""
    for line in [*lines, ""]:
        text = line.strip(" \t\f\r\n") if held else line.lstrip(" \t\f").rstrip("\r\n")
        if not held and (not text or text[0] in "#!"):
            continue
        text, held = held + text, ""
        if (len(text) - len(text.rstrip("\\"))) % 2:
            held = text[:-1]
            continue
        key, value = _PROPERTY.fullmatch(text).groups()
        found[_unescaped(key)] = _unescaped(value.rstrip(" \t\f"))
    return found


_PROPERTY = re.compile(r"((?:\\.|[^\\=: \t\f])*)[ \t\f]*[=:]?[ \t\f]*(.*)")
_ESCAPED = re.compile(r"\\(u[0-9A-Fa-f]{4}|.)")
# Signs that letters after a backslash stand for.
_SIGNS = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}


def _unescaped(text: str) -> str:
    def sign(match: re.Match) -> str:
        found = match[1]
        return chr(int(found[1:], 16)) if len(found) > 1 else _SIGNS.get(found, found)

    return _ESCAPED.sub(sign, text)


def kafka_options(properties: dict[str, str], topics: Iterable[str], per_batch: int | None = None) -> dict[str, str]:
    """Reader options from consumer properties: brokers, offsets and passed-through settings."""
    consumer = {
        key.removeprefix(CONSUMER_PREFIX): value
        for key, value in properties.items() if key.startswith(CONSUMER_PREFIX)
    }
    options = {f"kafka.{key}": value for key, value in consumer.items() if key not in _MANAGED}
    options |= {
        "kafka.bootstrap.servers": properties[BROKERS_KEY],
        "subscribe": ",".join(topics),
        "startingOffsets": consumer.get("auto.offset.reset", "latest"),
    }
    if per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The message texts of a Kafka subscription, in ``value``."""
    messages = spark.readStream.format("kafka").options(**options).load()
    return messages.select(F.col("value").cast("string").alias("value"))


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket, in ``value``. For trials only: Spark cannot replay a socket."""
    return spark.readStream.format("socket").options(host=host, port=port).load()


def file_stream(
    spark: SparkSession, schema: str | StructType, files_per_batch: int | None = None, max_age: str = ANY_AGE
) -> DataStreamReader:
    """A reader of files that arrive in a folder.

    ``max_age``: files that are older than the newest one by more than this are never read; by
    default none is, so files with old dates, as copies from an archive have, are not lost.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", max_age)
    return reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)


def file_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None, max_age: str = ANY_AGE
) -> DataFrame:
    """Lines of the text files that arrive in a folder, in ``value``; see ``file_stream``."""
    return file_stream(spark, "value string", files_per_batch, max_age).text(path)
