"""Counts of tokens and ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foyer.operators.rejects import REASON, reject_reason


def token_rows(lines: DataFrame, split: Callable[[Column], Column], *keep: str) -> DataFrame:
    """One row per token of ``value``, in ``token``, with the columns named in ``keep``."""
    return lines.select(*keep, F.explode(split(F.col("value"))).alias("token"))


def token_counts(lines: DataFrame, split: Callable[[Column], Column]) -> DataFrame:
    """Occurrences of each token."""
    return token_rows(lines, split).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def id_messages(lines: DataFrame) -> DataFrame:
    """``id`` and ``score`` of JSON messages, with ``line`` and ``reject_reason``: a good one has both fields."""
    message = F.from_json("value", "id string, score int, unreadable string", {"columnNameOfCorruptRecord": "unreadable"})
    return lines.select(F.col("value").alias("line"), message.alias("message")).select(
        "line", "message.id", "message.score",
        reject_reason(
            unreadable_message=F.col("message").isNull() | F.col("message.unreadable").isNotNull(),
            missing_id=F.col("message.id").isNull(),
            missing_score=F.col("message.score").isNull(),
        ),
    )


def id_counts(messages: DataFrame) -> DataFrame:
    """Messages per id."""
    return messages.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


def counts_and_rejects(rows: DataFrame, *keys: str) -> DataFrame:
    """Running counts of a stream's good rows per key and, in the same pass, its rejects: ``line``,
    ``reject_reason`` and how often the batch had them, with null keys.

    A reject is a group of its own, keyed by its line and time of arrival; the watermark on that time drops
    it from the state after its batch. Good rows have no such time, so their groups stay.
    """
    bad = F.col(REASON).isNotNull()
    parted = rows.select(
        *(F.when(~bad, F.col(key)).alias(key) for key in keys),
        F.when(bad, F.current_timestamp()).alias("arrived"),
        F.when(bad, F.coalesce("line", F.lit(""))).alias("line"), REASON,
    )
    watched = parted.withWatermark("arrived", "0 seconds")
    return watched.groupBy(*keys, "arrived", "line", REASON).agg(F.count(F.lit(1)).alias("n")).drop("arrived")


def window_counts(
    lines: DataFrame, split: Callable[[Column], Column], at: str, width: str = "5 seconds"
) -> DataFrame:
    """Occurrences of each token per tumbling window of the time column ``at``."""
    ones = token_rows(lines, split, at).withColumn("count", F.lit(1).cast("bigint"))
    counts = ones.groupBy(F.window(at, width).alias("span"), "token").agg(F.sum("count").alias("n"))
    return counts.select(F.col("span.start").alias("window_start"), "token", "n")


def arrival_window_counts(
    lines: DataFrame, split: Callable[[Column], Column], width: str = "5 seconds"
) -> DataFrame:
    """As ``window_counts`` by time of arrival, for a stream in ``append`` mode.

    Arrival times never run backwards, so a watermark of zero closes each window as the
    next begins: it comes out once, its state goes, and no row is late.
    """
    arriving = lines.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds")
    return window_counts(arriving, split, "arrived", width)


def flat_elements(rows: DataFrame, nested: str, *keep: str) -> DataFrame:
    """One row per innermost element of an array of arrays, in ``element``."""
    return rows.select(*keep, F.explode(F.flatten(nested)).alias("element"))
