"""Streaming queries: run the job over the whole input, return its table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foyer.functions.showing import SHOWING_KEY
from foyer.functions.text import line_field
from foyer.operators import sales, tickets
from foyer.operators.rejects import kept
from foyer.operators.sales import BOX_OFFICE_KEY
from foyer.plans import inputs
from foyer.plans.batch import OPENED, SINCE
from foyer.session import shared_folder
from foyer.sources.files import text_lines
from foyer.sources.streams import file_lines, file_stream
from foyer.streaming import jobs, run, upserts
from foyer.streaming.idle import THIRTY_HOURS_MS

Start = Callable[[str], StreamingQuery]


def _width(spark: SparkSession) -> int:
    """State partitions of a run that ends with its input: one per core."""
    return spark.sparkContext.defaultParallelism


def _table(spark: SparkSession, name: str, keys: Sequence[str], start: Start) -> DataFrame:
    """Run a keyed job to the end of its input in a new folder; its table."""
    folder = shared_folder(spark, name)
    run.finish(start(folder))
    return jobs.current_table(spark, folder, keys)


def _batches(spark: SparkSession, name: str, start: Start) -> DataFrame:
    """Run a per-batch job; here all input is one batch."""
    folder = shared_folder(spark, name)
    run.finish(start(folder))
    return spark.read.parquet(jobs.table_path(folder)).drop("batch_id")


def _feed(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    return inputs.ticket_stream(spark, sf_dir, files_per_batch)


def _quarter_of_tickets(spark: SparkSession, sf_dir: str) -> int:
    return max(1, len(inputs.table(spark, sf_dir, "lineitem").inputFiles()) // 4)


def ticket_sales_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sales per showing, the amount in whole currency units."""
    lines = _feed(spark, sf_dir)
    return _table(
        spark, "ticket-sales", SHOWING_KEY, lambda folder: jobs.ticket_sales(lines, folder, every=None, state_partitions=_width(spark))
    )


def csv_token_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of comma-separated tokens, keyed as the word table stores them."""
    lines = file_stream(spark, "value string").parquet(inputs.comma_files(spark, sf_dir))
    return _table(spark, "csv-tokens", ["token"], lambda folder: jobs.token_counts(lines, folder, every=None, state_partitions=_width(spark)))


def running_id_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.id_lines(inputs.table_stream(spark, sf_dir, "events"))
    return _table(spark, "id-counts", ["id"], lambda folder: jobs.id_counts(lines, folder, every=None, state_partitions=_width(spark)))


def _presale(spark: SparkSession, sf_dir: str, name: str, idle_ms: int | None) -> DataFrame:
    """The presale job on balances made of the lines sent before ``OPENED``."""
    sent = line_field(F.col("value"), 2)

    def write(path: str) -> None:
        earlier = inputs.ticket_feed(spark, sf_dir).where(sent < OPENED)
        jobs.land_balances(sales.box_office(kept(tickets.presale_tickets(earlier, SINCE))), path)

    balances = spark.read.parquet(inputs.landed(spark, sf_dir, "balances", "lineitem", write))
    lines = _feed(spark, sf_dir).where(sent >= OPENED)
    return _table(
        spark, name, BOX_OFFICE_KEY,
        lambda folder: jobs.presale(lines, SINCE, folder, balances, idle_ms, every=None, state_partitions=_width(spark)),
    )


def presale_seeded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running presale box office on opening balances."""
    return _presale(spark, sf_dir, "presale", None)


def stateful_idle_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the 30-hour idle timeout."""
    return _presale(spark, sf_dir, "presale-idle", THIRTY_HOURS_MS)


def tumbling_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per 5-second window of event time."""
    lines = inputs.event_lines(inputs.table_stream(spark, sf_dir, "events"))
    windows = _table(
        spark, "window-counts", ["window_start", "token"],
        lambda folder: jobs.event_window_counts(lines, "at", folder, every=None, state_partitions=_width(spark)),
    )
    return windows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def pipe_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of pipe-separated tokens within the batch."""
    lines = inputs.pipe_lines(inputs.table_stream(spark, sf_dir, "part"))
    return _batches(spark, "pipe-tokens", lambda folder: jobs.batch_token_counts(lines, folder, every=None))


def fanout_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts of the batch's tickets joined with themselves on the showing key."""
    lines = _feed(spark, sf_dir)
    return _batches(spark, "fanout-join", lambda folder: jobs.showing_pairs(lines, folder, every=None)).select(
        *SHOWING_KEY, "pairs", "amount"
    )


def _quarter_of_files(spark: SparkSession, path: str) -> int:
    return max(1, len(text_lines(spark, path).inputFiles()) // 4)


def stream_upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running id counts over several batches into a table of buckets that fold as they change."""
    path = inputs.id_files(spark, sf_dir)
    lines = file_lines(spark, path, files_per_batch=_quarter_of_files(spark, path))

    def start(folder: str) -> StreamingQuery:
        write = upserts.upsert_table(jobs.table_path(folder), ["id"], buckets=_width(spark))
        return jobs.id_counts(lines, folder, every=None, state_partitions=_width(spark), write=write)

    return _table(spark, "upsert", ["id"], start)


def every_key_each_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of several batches of running id counts, each of which gives all keys."""
    path = inputs.id_files(spark, sf_dir)
    folder = shared_folder(spark, "whole")
    lines = file_lines(spark, path, files_per_batch=_quarter_of_files(spark, path))
    run.finish(jobs.all_id_counts(lines, folder, every=None, state_partitions=_width(spark)))
    return upserts.whole_copy(spark, jobs.table_path(folder))


def running_distinct_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different show codes per showing, from sketches that several batches add to."""
    lines = _feed(spark, sf_dir, _quarter_of_tickets(spark, sf_dir))
    return sales.estimated_shows(_table(
        spark, "distinct-shows", SHOWING_KEY,
        lambda folder: jobs.distinct_shows(lines, folder, every=None, state_partitions=_width(spark)),
    ))


def late_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per 5-second window of event time, behind a watermark that no line of one batch is late for."""
    lines = inputs.event_lines(inputs.table_stream(spark, sf_dir, "events"))
    counted = _table(
        spark, "late-windows", ["window_start", "token"],
        lambda folder: jobs.event_window_counts(lines, "at", folder, every=None, delay=timedelta(minutes=10)),
    )
    return counted.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "token", "n")


def restart_from_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sales stopped after the first batch, then started again to the end."""
    folder = shared_folder(spark, "restart")

    def start(every: str | None) -> StreamingQuery:
        lines = _feed(spark, sf_dir, _quarter_of_tickets(spark, sf_dir))
        return jobs.ticket_sales(lines, folder, every, state_partitions=_width(spark))

    run.stop_after_batches(start("0 seconds"), 1)
    run.finish(start(None))
    return jobs.current_table(spark, folder, SHOWING_KEY)


QUERIES = {
    "ticket_sales_running": ticket_sales_running,
    "csv_token_running": csv_token_running,
    "running_id_count": running_id_count,
    "presale_seeded_state": presale_seeded_state,
    "stateful_idle_timeout": stateful_idle_timeout,
    "tumbling_window_count": tumbling_window_count,
    "pipe_token_count": pipe_token_count,
    "fanout_join_stream": fanout_join_stream,
    "stream_upsert_snapshot": stream_upsert_snapshot,
    "restart_from_checkpoint": restart_from_checkpoint,
    "every_key_each_batch": every_key_each_batch,
    "running_distinct_shows": running_distinct_shows,
    "late_window_count": late_window_count,
}
