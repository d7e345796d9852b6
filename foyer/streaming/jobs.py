"""The streaming applications: from feed lines to a started stream.

Each takes lines from any source (Kafka, socket, files) and a folder for its checkpoint
and table, and returns the running query. ``every`` is the batch interval; with ``None``
the stream takes what is there and ends. ``write`` replaces the table below the folder,
for example by ``sinks.jdbc_upsert``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foyer.functions.showing import SHOWING_KEY
from foyer.functions.text import full_trim, space_tokens, tokens
from foyer.operators import counts, sales, tickets
from foyer.operators.rejects import counted, kept
from foyer.operators.sales import BOX_OFFICE_KEY
from foyer.streaming import idle, run, sinks, upserts, windows
from foyer.streaming.run import BatchWriter
from foyer.streaming.tables import sales_table, trimmed_tokens

Tokens = Callable[[Column], Column]


def comma_tokens(text: Column) -> Column:
    return tokens(text, ",")


def pipe_tokens(text: Column) -> Column:
    return tokens(text, "|")


def table_path(folder: str) -> str:
    return f"{folder}/table"


def current_table(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """The rows a keyed job has in its table now."""
    return upserts.upserted(spark, table_path(folder), keys)


def _keyed(
    rows: DataFrame, folder: str, keys: Sequence[str], every: str | None,
    write: BatchWriter | None, **how,
) -> StreamingQuery:
    if write is None:
        upserts.declare(rows, table_path(folder))
        write = upserts.upsert_table(table_path(folder), keys)
    return run.start(rows, write, f"{folder}/checkpoint", every, **how)


def _per_batch(
    lines: DataFrame, folder: str, every: str | None, step: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    write = sinks.batch_tables(table_path(folder), step)
    return run.start(lines, write, f"{folder}/checkpoint", every)


def _good(rows: DataFrame) -> DataFrame:
    # Without the line, which counting in passing would carry along for each ticket.
    return kept(counted(rows.drop("line"), "tickets"))


def ticket_sales(
    lines: DataFrame, folder: str, every: str | None = "10 seconds",
    write: BatchWriter | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running tickets and amount per showing, in whole currency units."""
    good = _good(tickets.sale_tickets(lines))
    return _keyed(sales_table(sales.sales_by_showing(good)), folder, SHOWING_KEY, every, write, state_partitions=state_partitions)


def land_balances(table: DataFrame, path: str) -> None:
    """Copy a table of opening balances, from JDBC or elsewhere, to shared storage, so that a first
    batch that is repeated reads the same."""
    table.write.mode("overwrite").parquet(path)


def presale(
    lines: DataFrame, since: str, folder: str, balances: DataFrame | None = None,
    idle_ms: int | None = idle.THIRTY_HOURS_MS, every: str | None = "5 seconds",
    write: BatchWriter | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running presale box office on opening balances, forgetting a key after ``idle_ms``
    without tickets; with ``None`` no key is forgotten.

    ``balances`` is a table, read for the first batch of a checkpoint alone: rows that it gains
    later, or a restart, change nothing.
    """
    arriving = _good(tickets.presale_tickets(lines, since))
    rows = idle.running_box_office(arriving, balances, idle_ms)
    return _keyed(
        rows, folder, BOX_OFFICE_KEY, every, write,
        idle_batches=idle_ms is not None and every is not None, state_partitions=state_partitions,
    )


def token_counts(
    lines: DataFrame, folder: str, every: str | None = "10 seconds",
    write: BatchWriter | None = None, split: Tokens = comma_tokens,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running counts of tokens, trimmed as the word table stores them."""
    words = trimmed_tokens(counts.token_rows(lines, split))
    running = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return _keyed(running, folder, ["token"], every, write, state_partitions=state_partitions)


def id_counts(
    lines: DataFrame, folder: str, every: str | None = "5 seconds",
    write: BatchWriter | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running counts of the ids of JSON messages, trimmed as the word table stores them.

    The batch that has a bad message also writes it to the table's rejects, and counts it in its progress.
    """
    messages = counts.id_messages(lines).withColumn("id", full_trim(F.col("id")))
    running = counts.counts_and_rejects(counted(messages, "messages"), "id")
    return _keyed(running, folder, ["id"], every, write, state_partitions=state_partitions)


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The bad lines that a keyed job has met: batch, line, reason and how often in the batch."""
    return upserts.rejects(spark, table_path(folder))


def showing_pairs(lines: DataFrame, folder: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Per batch: its tickets joined with themselves on the showing key, then summed."""
    def step(batch: DataFrame) -> DataFrame:
        return sales.self_join_totals(kept(tickets.sale_tickets(batch)), SHOWING_KEY, "amount")

    return _per_batch(lines, folder, every, step)


def batch_token_counts(
    lines: DataFrame, folder: str, every: str | None = "1 second", split: Tokens = pipe_tokens,
) -> StreamingQuery:
    """Per batch: counts of tokens."""
    return _per_batch(lines, folder, every, lambda batch: counts.token_counts(batch, split))


def window_token_counts(
    lines: DataFrame, folder: str, every: str | None = "1 second", width: str = "5 seconds",
    split: Tokens = space_tokens,
) -> StreamingQuery:
    """Counts of tokens per window of arrival time, each window once, when it is over."""
    found = counts.arrival_window_counts(lines, split, width)
    write = sinks.batch_tables(table_path(folder), lambda batch: batch)
    return run.start(found, write, f"{folder}/checkpoint", every, mode="append")


def event_window_counts(
    lines: DataFrame, at: str, folder: str, every: str | None = "1 second",
    width: str = "5 seconds", split: Tokens = space_tokens,
    state_partitions: int | None = None, delay: timedelta | None = None,
) -> StreamingQuery:
    """Counts of tokens per window of the time column ``at``.

    With ``delay``, windows that the latest time has passed by more than that are over: their
    totals stay in the table, and lines that still come for them are in ``rejected_lines``. Without, no
    line is ever late and the state holds all windows.
    """
    if delay is not None:
        write = windows.window_table(table_path(folder), split, at, width, delay)
        return run.start(lines, write, f"{folder}/checkpoint", every, mode="append")
    found = counts.window_counts(lines, split, at, width)
    return _keyed(found, folder, ["window_start", "token"], every, None, state_partitions=state_partitions)


def all_id_counts(
    lines: DataFrame, folder: str, every: str | None = "5 seconds", keep: int = 10,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running counts of ids, all of them in every batch: each batch replaces the table whole.

    Bad messages are counted in the progress.
    """
    messages = counts.id_messages(lines).withColumn("id", full_trim(F.col("id")))
    running = counts.id_counts(kept(counted(messages, "messages")))
    write = upserts.whole_table(table_path(folder), keep)
    return run.start(running, write, f"{folder}/checkpoint", every, mode="complete", state_partitions=state_partitions)


def distinct_shows(
    lines: DataFrame, folder: str, every: str | None = "10 seconds",
    write: BatchWriter | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Per showing, a sketch of its different show codes; see ``sales.estimated_shows``."""
    good = _good(tickets.sale_tickets(lines, shows=True))
    return _keyed(sales.show_sketches(good), folder, SHOWING_KEY, every, write, state_partitions=state_partitions)
