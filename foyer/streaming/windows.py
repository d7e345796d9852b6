"""Counts per window of event time behind a watermark, with a side path for late rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from foyer.operators.rejects import REASON
from foyer.streaming import upserts
from foyer.streaming.run import BatchWriter

KEYS = ("window_start", "token")
LATE, NO_TIME = "late", "no time"


def late_counts(
    batch: DataFrame, split: Callable[[Column], Column], at: str, width: str, mark: datetime | None
) -> DataFrame:
    """Occurrences of each token per window, and the lines whose window is over or that have no time:
    ``window_start``, ``token``, ``line``, ``reject_reason`` and ``n``. A window is over when its end is not
    behind ``mark``.
    """
    # A window step leaves out rows without a time: they get one here, and their reason.
    epoch = F.lit(datetime(1970, 1, 1)).cast(batch.schema[at].dataType)
    span = F.window(F.coalesce(F.col(at), epoch), width)
    late = F.lit(False) if mark is None else span["end"] <= F.lit(mark)
    reason = F.when(F.col(at).isNull(), F.lit(NO_TIME)).when(late, F.lit(LATE))
    timed = batch.select(span["start"].alias("window_start"), reason.alias(REASON), "value")
    # A rejected line stays one row; the others become a row per token.
    bad = F.col(REASON).isNotNull()
    each = timed.select(
        "window_start", F.when(bad, F.coalesce("value", F.lit(""))).alias("line"), REASON,
        F.explode(F.when(bad, F.array(F.lit(None).cast("string"))).otherwise(split(F.col("value")))).alias("token"),
    )
    return each.groupBy("window_start", "token", "line", REASON).agg(F.count(F.lit(1)).alias("n"))


def window_table(
    path: str, split: Callable[[Column], Column], at: str, width: str, delay: timedelta, **how
) -> BatchWriter:
    """Write batches of lines as totals per window and token.

    The watermark is the latest time of earlier batches less ``delay``. Lines of windows that it has passed go to the
    table's rejects, as ``late``, by the same pass; the other windows are open. A batch reads the
    totals of the open windows that the batch before it wrote, adds its own, and writes them again:
    what it reads and holds is bounded by the delay, not by the stream's age. The watermark is kept in the batch's
    manifest, so a batch that is retried starts from the same one.
    """
    put = upserts.upsert_table(path, KEYS, **how)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = upserts.manifest(spark, path, batch_id)
        mark = base.notes.get("mark") if base else None
        mark = datetime.fromisoformat(mark) if mark else None
        seen = Observation()
        found = late_counts(batch.observe(seen, F.max(at).alias("latest")), split, at, width, mark)
        if base is not None and base.own:
            ends = F.col("window_start") + F.expr(f"interval {width}")
            before = upserts.own_rows(spark, path, base).select(found.columns)
            before = before.where(F.lit(True) if mark is None else ends > F.lit(mark))
            found = found.unionByName(before).groupBy("window_start", "token", "line", REASON).agg(F.sum("n").alias("n"))

        def notes() -> dict:
            latest = seen.get["latest"]
            after = [t for t in (mark, latest - delay if latest is not None else None) if t is not None]
            return {"mark": max(after).isoformat()} if after else {}

        put(found, batch_id, notes)

    return write
