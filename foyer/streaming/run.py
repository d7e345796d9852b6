"""Starting, draining and restarting streams."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from threading import Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def stream_settings(
    spark: SparkSession, state_partitions: int | None = None, idle_batches: bool = True
) -> Iterator[None]:
    """Session settings a stream copies when it starts; the session's own return after.

    State lives in RocksDB, off the heap, with change logs as checkpoints. Its partition
    count is fixed for the life of a checkpoint, so it is an argument of every job, by default
    the session's shuffle partitions; how many executors happen to be there does not count.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions")),
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower(),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start(
    rows: DataFrame, write: BatchWriter, checkpoint: str, every: str | None = None,
    mode: str = "update", state_partitions: int | None = None, idle_batches: bool = True,
) -> StreamingQuery:
    """Start a stream into ``write(batch, batch_id)``.

    ``every`` is the batch interval, as in ``"10 seconds"``; without it the stream takes
    all that is available and ends. A second start on the same checkpoint continues.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
    )
    with stream_settings(rows.sparkSession, state_partitions, idle_batches):
        return writer.start()


def finish(query: StreamingQuery, limit: float | None = None) -> None:
    """Wait for an ``availableNow`` stream to end, however long; raise its failure.

    ``limit``, in seconds, is for tests: beyond it the stream is stopped with an error.
    """
    try:
        if limit is None:
            query.awaitTermination()
        elif not query.awaitTermination(limit):
            raise TimeoutError(f"stream still running after {limit} s")
    finally:
        query.stop()


def drain(query: StreamingQuery) -> None:
    """Graceful stop: handle the data that has arrived, then stop, though more keep arriving.

    The batch that runs now and the one after it hold all that was there; what comes later is
    read after a restart on the same checkpoint.
    """
    def last() -> int:
        return query.lastProgress["batchId"] if query.lastProgress else -1

    caught_up = Thread(target=_caught_up, args=(query,), daemon=True)
    before = last()
    caught_up.start()
    while query.isActive and caught_up.is_alive() and last() < before + 2:
        time.sleep(0.05)
    query.stop()
    if query.exception() is not None:
        raise query.exception()


def _caught_up(query: StreamingQuery) -> None:
    # Ends with an error when the query is stopped first; drain() looks at the query itself.
    with suppress(Exception):
        query.processAllAvailable()


def stop_after_batches(query: StreamingQuery, batches: int, limit: float | None = None) -> None:
    """Stop a stream once it has completed ``batches`` batches since it started."""
    deadline = float("inf") if limit is None else time.monotonic() + limit
    try:
        while query.isActive and len(query.recentProgress) < batches:
            if time.monotonic() > deadline:
                raise TimeoutError(f"no {batches} batches within {limit} s")
            time.sleep(0.1)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
