"""Catalog and JDBC tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def attach_table(spark: SparkSession, name: str, path: str, source: str = "parquet") -> DataFrame:
    """Enter existing files into the catalog under ``name``; nothing is copied."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {source} LOCATION '{path}'")
    return spark.table(name)


def point_filter(table: DataFrame, column: str, value: object) -> DataFrame:
    """All columns of the rows whose ``column`` equals ``value``; reaches the scan."""
    return table.where(F.col(column) == F.lit(value))


@dataclass(frozen=True)
class Slices:
    """How to cut a JDBC table into parallel reads: ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.count),
        }


def jdbc_options(
    url: str, table: str, properties: dict[str, str] | None = None,
    slices: Slices | None = None, fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Reader options for a JDBC table."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)} | (properties or {})
    return options | slices.options() if slices else options


def jdbc_table(spark: SparkSession, url: str, table: str, **how) -> DataFrame:
    """A JDBC table as a DataFrame. Give ``slices`` for any large table, or one task reads all."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **how)).load()
