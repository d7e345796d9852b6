"""Files of even size from batches of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame

_ADAPTIVE = "spark.sql.adaptive.enabled"


def write_even(rows: DataFrame, path: str, *keys: str, by: str | None = None) -> None:
    """Write in files of even size: a small batch of many state partitions in one file, a
    large one in many; with ``by``, for each value of that column below a folder of its own.

    Streams run without adaptive execution, which does this; for the write, whose input is
    already planned, it is safe to have.
    """
    conf = rows.sparkSession.conf
    before = conf.get(_ADAPTIVE)
    conf.set(_ADAPTIVE, "true")
    try:
        writer = rows.hint("rebalance", *keys).write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
    finally:
        conf.set(_ADAPTIVE, before)
