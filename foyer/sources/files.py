"""Text, landed-log and JSON-lines scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foyer.functions.text import full_trim, line_field
from foyer.schemas import ticket_table


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in ``value``."""
    return spark.read.schema("value string").text(path)


def landed_log(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """``data`` and ``sendTime`` of the log below ``root/dt=<date>/``, with ``dt``.

    ``dates`` prunes to those partitions before any file is opened.
    """
    lines = spark.read.schema("value string, dt string").text(root)
    if dates is not None:
        lines = lines.where(F.col("dt").isin(list(dates)))
    return log_fields(lines)


def log_fields(lines: DataFrame) -> DataFrame:
    """``data``, ``sendTime`` and ``dt`` of log lines in ``value`` with their ``dt``."""
    line = F.col("value")
    return lines.select(
        line_field(line, 0).alias("data"),
        full_trim(line_field(line, 1)).alias("sendTime"),
        "dt",
    )


def json_tickets(spark: SparkSession, path: str) -> DataFrame:
    """Ticket orders stored one JSON object per line, all 46 columns declared."""
    return spark.read.schema(ticket_table()).json(path)


def write_text(lines: DataFrame, path: str) -> None:
    """Write a one-column result as text, replacing what is there; one file per task."""
    lines.write.mode("overwrite").text(path)
