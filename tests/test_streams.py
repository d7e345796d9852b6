from __future__ import annotations

import os
import re
import time
from datetime import timedelta

import pyarrow as pa
import pytest
from conftest import line, rows, ticket
from pyspark.sql import functions as F

from foyer.functions.showing import SHOWING_KEY
from foyer.functions.text import tokens
from foyer.operators import counts, sales
from foyer.operators.sales import BOX_OFFICE_KEY
from foyer.sources.streams import file_lines
from foyer.streaming import idle, jobs, run, sinks, upserts
from foyer.streaming.tables import trimmed_tokens


@pytest.fixture
def feed(tmp_path):
    """A folder to which each call adds a file of lines."""
    folder = tmp_path / "feed"
    folder.mkdir()

    def add(*texts: str) -> str:
        number = len(list(folder.iterdir()))
        draft = tmp_path / f"draft-{number}"
        draft.write_text("\n".join(texts) + "\n")
        draft.rename(folder / f"{number:03d}.txt")
        return str(folder)

    return add


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "checkpoint")


def words(lines):
    return counts.token_counts(lines, lambda value: tokens(value, ","))


def test_running_count_over_batches_and_restarts_equals_batch(spark, feed, places):
    log, checkpoint = places
    feed("a,b,a", "c,,")
    path = feed("a")

    def go():
        running = words(file_lines(spark, path, files_per_batch=1))
        run.finish(run.start(running, upserts.upsert_table(log, ["token"]), checkpoint))
        return rows(upserts.upserted(spark, log, ["token"]))

    assert go() == [("a", 3), ("b", 1), ("c", 1)]
    feed("b,d", "a")
    assert go() == rows(words(spark.read.text(path))) == [("a", 4), ("b", 2), ("c", 1), ("d", 1)]
    assert go() == [("a", 4), ("b", 2), ("c", 1), ("d", 1)]


def test_stop_mid_way_and_continue(spark, feed, places):
    log, checkpoint = places
    for text in "aabab":
        path = feed(text)

    def begin(**how):
        running = words(file_lines(spark, path, files_per_batch=1))
        return run.start(running, upserts.upsert_table(log, ["token"]), checkpoint, **how)

    run.stop_after_batches(begin(every="0 seconds"), 1)
    run.finish(begin())
    assert rows(upserts.upserted(spark, log, ["token"])) == [("a", 3), ("b", 2)]


def test_drain_takes_everything_then_stops(spark, feed, places):
    log, checkpoint = places
    query = run.start(words(file_lines(spark, feed("a"))), upserts.upsert_table(log, ["token"]), checkpoint, every="0 seconds")
    feed("a,b")
    run.drain(query)
    assert not query.isActive
    assert rows(upserts.upserted(spark, log, ["token"])) == [("a", 2), ("b", 1)]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with run.stream_settings(spark, state_partitions=3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_failure_of_the_sink_is_raised(spark, feed, places):
    def fail(batch, batch_id):
        raise RuntimeError("no space in the table")

    with pytest.raises(Exception, match="no space in the table"):
        run.finish(run.start(words(file_lines(spark, feed("a"))), fail, places[1]))


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, n bigint, s string").coalesce(1)


def test_upsert_later_wins_and_a_retry_replaces(spark, places):
    log, _ = places
    write = upserts.upsert_table(log, ["k"])
    write(frame(spark, ("a", 1, "x"), ("b", 1, "x")), 0)
    write(frame(spark, ("a", 9, "wrong"), ("w", 9, "wrong")), 1)
    write(frame(spark, ("a", 2, "y")), 1)
    assert rows(upserts.upserted(spark, log, ["k"])) == [("a", 2, "y"), ("b", 1, "x")]
    write(frame(spark, ("c", 5, None), (None, 6, "null key")), 2)
    write(frame(spark), 3)
    write(frame(spark, (None, 7, None)), 4)
    found = rows(upserts.upserted(spark, log, ["k"]))
    assert found == [("a", 2, "y"), ("b", 1, "x"), ("c", 5, None), (None, 7, None)]


def test_readers_see_the_old_or_the_new_rows(spark, places, monkeypatch):
    """Between any two steps of a batch, and of its retry, the table is that of one batch."""
    log, _ = places
    write = upserts.upsert_table(log, ["k"], buckets=4, share=0.1)
    old = [(str(i), 0, "old") for i in range(40)]
    new = [(str(i), 1, "new") for i in range(40)]
    write(frame(spark, *old), 0)
    seen, fail, step = [], [], upserts._written
    put = upserts._Folder.put

    def look():
        seen.append(rows(upserts.upserted(spark, log, ["k"])))

    def watched(*how):
        look()
        found = step(*how)
        look()
        if fail:
            raise OSError(fail.pop())
        return found

    def putting(folder, name, text):
        look()
        put(folder, name, text)
        look()

    monkeypatch.setattr(upserts, "_written", watched)
    monkeypatch.setattr(upserts._Folder, "put", putting)
    before = upserts.upserted(spark, log, ["k"])
    fail.append("lost")
    with pytest.raises(OSError, match="lost"):
        write(frame(spark, *new), 1)
    assert all(found == sorted(old, key=repr) for found in seen)
    write(frame(spark, *new), 1)
    write(frame(spark, *new), 1)
    assert {found[0][2] for found in seen} == {"old", "new"}
    assert all(found in (sorted(old, key=repr), sorted(new, key=repr)) for found in seen)
    # A reader that began before goes on with what it saw.
    assert rows(before) == sorted(old, key=repr)


def test_rewritten_bytes_follow_the_changed_keys(spark, places):
    log, _ = places
    write = upserts.upsert_table(log, ["k"], buckets=4)

    def numbered(ids, n):
        return spark.createDataFrame(ids, "long").select(
            F.col("value").cast("string").alias("k"), F.lit(n).cast("long").alias("n"),
            F.sha2(F.concat_ws(":", "value", F.lit(n)), 256).alias("s"),
        )

    write(numbered(list(range(20_000)), 0), 0)
    whole = sum(p.size for parts in upserts.manifest(spark, log).parts.values() for p in parts)
    few, written, rewritten = 200, 0, []
    for batch in range(1, 21):
        write(numbered(list(range(few)), batch), batch)
        found = upserts.manifest(spark, log)
        rewritten.append(found.rewritten)
        assert max(map(len, found.parts.values())) < 3 * upserts.FAN
    # Small changes are merged among themselves; no bucket is folded for them.
    assert any(rewritten) and max(rewritten) < whole / 10 and sum(rewritten) < whole / 2
    write(numbered(list(range(15_000)), 21), 21)
    assert upserts.manifest(spark, log).rewritten > whole / 2
    assert upserts.upserted(spark, log, ["k"]).groupBy("n").count().orderBy("n").collect() == [(0, 5000), (21, 15_000)]


def test_a_small_batch_is_one_file_a_bucket(spark, places):
    log, _ = places
    many = frame(spark, *((str(i), i, "") for i in range(50))).repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        upserts.upsert_table(log, ["k"], buckets=2)(many, 0)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    written = upserts.upserted(spark, log, ["k"])
    assert len(written.inputFiles()) == 2 and written.count() == 50


def test_ids_are_trimmed_before_they_are_counted(spark, feed, tmp_path):
    lines = file_lines(spark, feed('{"id":" a","score":1}', '{"id":"a\\t","score":1}'))
    run.finish(jobs.id_counts(lines, str(tmp_path), every=None))
    assert rows(jobs.current_table(spark, str(tmp_path), ["id"])) == [("a", 2)]


def test_upsert_statements():
    mysql = sinks.upsert_statement("t", "s", ["k", "n"], ["k"], "jdbc:mysql://h/db")
    assert mysql == "REPLACE INTO t (k, n) SELECT k, n FROM s"
    merge = sinks.upsert_statement("t", "st", ["k", "n"], ["k"], "jdbc:postgresql://h/db")
    assert merge == (
        "MERGE INTO t t USING st s ON t.k = s.k WHEN MATCHED THEN UPDATE SET n = s.n"
        " WHEN NOT MATCHED THEN INSERT (k, n) VALUES (s.k, s.n)"
    )


def test_sales_table_and_reject_metrics(spark, feed, tmp_path):
    path = feed(line(ticket()), line(ticket(isRefund="Y")), line(ticket(movieCode="1")))
    query = jobs.ticket_sales(file_lines(spark, path), str(tmp_path), every=None)
    run.finish(query)
    assert rows(jobs.current_table(spark, str(tmp_path), SHOWING_KEY)) == [("139", "8", "2019-12-19", "17:20", "05102342019", 2, 140.0)]
    metrics = [p.observedMetrics["tickets"] for p in query.recentProgress if "tickets" in p.observedMetrics]
    assert [(m["seen"], m["rejected"]) for m in metrics][0] == (3, 1)


def test_trimmed_tokens_add_up(lines):
    spellings = counts.token_rows(lines("a, a,\ta ,b"), lambda value: tokens(value, ","))
    assert rows(trimmed_tokens(spellings).groupBy("token").count()) == [("a", 3), ("b", 1)]


def test_per_batch_results_do_not_mix_batches(spark, feed, places):
    log, checkpoint = places
    feed("a,a")
    path = feed("a,b")
    run.finish(run.start(file_lines(spark, path, files_per_batch=1), sinks.batch_tables(log, words), checkpoint))
    found = spark.read.parquet(log).select("batch_id", "token", "n")
    assert rows(found) == [(0, "a", 2), (1, "a", 1), (1, "b", 1)]


def test_console_runs(spark, feed, places):
    query = sinks.console(words(file_lines(spark, feed("a"))), places[1], every="0 seconds")
    run.drain(query)
    assert query.exception() is None and query.recentProgress[0].numInputRows == 1


@pytest.mark.parametrize("idle_ms", [None, idle.THIRTY_HOURS_MS])
def test_seed_is_the_opening_balance_of_a_stream(spark, feed, tmp_path, idle_ms):
    key = ("2019-12-19", "17:20:00", "139", "051402342019")
    schema = ", ".join([*(f"{name} string" for name in BOX_OFFICE_KEY), "ticket_num bigint, ticket_amt bigint"])
    seed = str(tmp_path / "seed")
    jobs.land_balances(spark.createDataFrame([(*key, 10, 100_000), (*key[:3], "other", 3, 3)], schema), seed)
    feed(line(ticket()))
    path = feed(line(ticket()), line(ticket(isRefund="Y")), line(ticket()))
    lines = file_lines(spark, path, files_per_batch=1)
    folder = str(tmp_path)
    balances = spark.read.parquet(seed)
    run.finish(jobs.presale(lines, "2019-12-01", folder, balances, idle_ms, every=None))
    assert rows(jobs.current_table(spark, folder, BOX_OFFICE_KEY)) == [(*key, 12, 114_000)]


class FakeHandle:
    """Keeps one key's state and timers in memory."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    get = lambda self: self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    registerTimer = lambda self, at: self.timers.append(at)


class At:
    def __init__(self, now):
        self.getCurrentProcessingTimeInMs = lambda: now


@pytest.fixture
def office():
    handle = FakeHandle()
    state = idle.BoxOfficeState(1000)
    state.init(handle)

    def add(now, *measures):
        rows = iter([{"ticket_num": n, "ticket_amt": a} for n, a in measures])
        return [tuple(row) for row in state.handleInputRows(("k",), rows, At(now))]

    def expire(now):
        handle.timers.pop(0)
        return [tuple(row) for row in state.handleExpiredTimer(("k",), At(now), None)]

    return handle, state, add, expire


def test_idle_state_adds_expires_and_starts_again(office):
    handle, _, add, expire = office
    assert add(0, (1, 10), (2, 20), (-1, -5)) == [("k", 2, 25)]
    assert (handle.value, handle.timers) == ((2, 25, 1000), [1000])
    assert add(700, (1, 1)) == [("k", 3, 26)] and handle.timers == [1000]
    # The timer of the first ticket goes off, but the key was not idle: it is set anew.
    assert expire(1000) == [] and handle.timers == [1700]
    assert expire(1700) == [("k", 3, 26)]
    assert handle.value is None and handle.timers == []
    assert add(1800, (1, 1)) == [("k", 1, 1)] and handle.timers == [2800]


def test_idle_state_keeps_a_balance_quiet_until_a_ticket_or_the_timeout(office):
    handle, state, add, expire = office
    state.handleInitialState(("k",), {"ticket_num": 10, "ticket_amt": 1000}, At(0))
    assert add(1, (1, 7)) == [("k", 11, 1007)]
    handle.value, handle.timers = None, []
    state.handleInitialState(("k",), {"ticket_num": 10, "ticket_amt": 1000}, At(0))
    assert expire(1000) == [("k", 10, 1000)] and handle.value is None


def test_a_late_balance_or_a_restart_changes_nothing(spark, feed, tmp_path):
    key = ("2019-12-19", "17:20:00", "139", "051402342019")
    schema = ", ".join([*(f"{name} string" for name in BOX_OFFICE_KEY), "ticket_num bigint, ticket_amt bigint"])
    seed, folder = str(tmp_path / "seed"), str(tmp_path / "job")
    balance = spark.createDataFrame([(*key, 10, 1000), (*key, 1, 1)], schema)
    jobs.land_balances(balance, seed)
    path = feed(line(ticket()))

    def go():
        lines = file_lines(spark, path, files_per_batch=1)
        run.finish(jobs.presale(lines, "2019-12-01", folder, spark.read.parquet(seed), every=None), 300)
        return rows(jobs.current_table(spark, folder, BOX_OFFICE_KEY))

    assert go() == [(*key, 12, 8001)]
    balance.write.mode("append").parquet(seed)
    assert go() == [(*key, 12, 8001)]
    feed(line(ticket()))
    assert go() == [(*key, 13, 15001)]


def test_a_key_expires_across_a_restart(spark, feed, tmp_path):
    log = str(tmp_path / "log")
    path = feed(line(ticket()))
    write = sinks.batch_tables(log, lambda batch: batch)

    def go():
        lines = file_lines(spark, path)
        run.finish(jobs.presale(lines, "2019-12-01", str(tmp_path), idle_ms=1500, every=None, write=write), 300)
        return rows(spark.read.parquet(log).select("batch_id", "cinemaInnerCode", "ticket_num"))

    assert go() == [(0, "139", 1)]
    time.sleep(2)
    feed(line(ticket(cinemaInnerCode="7")))
    # One batch later the first key has come out once more; no empty batch was run for it.
    assert go() == [(0, "139", 1), (1, "139", 1), (1, "7", 1)]
    feed(line(ticket()))
    assert (2, "139", 1) in go()


def test_idle_combiner_sums_whole_stretches(monkeypatch):
    monkeypatch.setattr(idle, "_HELD_ROWS", 5)
    batch = pa.RecordBatch.from_pydict(
        {"key": ["a", "a", "b"], "ticket_num": [1, 1, -1], "ticket_amt": [5, 6, -7]}
    )
    out = [row for part in idle._combine([batch] * 3) for row in part.to_pylist()]
    assert [tuple(row.values()) for row in out] == [
        ("a", 4, 22), ("b", -2, -14), ("a", 2, 11), ("b", -1, -7)
    ]


def test_idle_combiner_sums_the_sums_of_stretches_by_all_parts_of_a_key(monkeypatch):
    monkeypatch.setattr(idle, "_HELD_ROWS", 5)
    batch = pa.RecordBatch.from_pydict(
        {"movieCode": ["m", "m", "m", None, "m"], "date_id": ["1", "1", "2", "1", "1"],
         "ticket_num": [1, 1, -1, 1, -1], "ticket_amt": [5, 6, -7, 2, -5]}
    )
    out = [tuple(row.values()) for part in idle._combine_twice([batch] * 4) for row in part.to_pylist()]
    # Two stretches have three keys each, which makes six sums: past the limit, so they come out in pairs.
    assert out == [("m", "1", 2, 12), ("m", "2", -2, -14), (None, "1", 2, 4)] * 2


def test_idle_stream_forgets_a_quiet_key(spark, feed, tmp_path):
    log = str(tmp_path / "log")
    path = feed(line(ticket()))
    write = sinks.batch_tables(log, lambda batch: batch)
    query = jobs.presale(
        file_lines(spark, path), "2019-12-01", str(tmp_path), idle_ms=1500, every="1 second", write=write
    )

    def seen() -> list[int]:
        table = spark.read.schema("ticket_num bigint, batch_id int").parquet(log)
        return [row[0] for row in table.orderBy("batch_id").select("ticket_num").collect()]

    def wait(count: int) -> None:
        deadline = time.monotonic() + 90
        while time.monotonic() < deadline:
            if query.exception() is not None:
                raise query.exception()
            try:
                if len(seen()) >= count:
                    return
            except Exception as error:
                if "PATH_NOT_FOUND" not in str(error) and "FILE_NOT_EXIST" not in str(error):
                    raise
            time.sleep(0.5)
        raise AssertionError(f"{count} rows did not come")

    try:
        wait(2)
        feed(line(ticket()))
        wait(3)
    finally:
        query.stop()
    # The ticket, its last total on expiry, then a count that starts from nothing.
    assert seen()[:3] == [1, 1, 1]


def test_arrival_windows_come_out_once(spark, feed, tmp_path):
    lines = file_lines(spark, feed("a b a"))
    query = jobs.window_token_counts(lines, str(tmp_path), every="0 seconds", width="1 second")
    try:
        query.processAllAvailable()
        time.sleep(1.5)
        feed("c")
        query.processAllAvailable()
    finally:
        query.stop()
    found = spark.read.parquet(jobs.table_path(str(tmp_path)))
    assert rows(found.select("token", "n")) == [("a", 2), ("b", 1)]
    assert found.select("window_start").distinct().count() == 1


def test_event_windows(spark, lines):
    stamped = lines("a b", "a").select(F.lit("2024-01-01 00:00:07").cast("timestamp_ntz").alias("at"), "value")
    found = counts.window_counts(stamped, lambda value: tokens(value, " "), "at")
    assert rows(found.select(F.date_format("window_start", "HH:mm:ss"), "token", "n")) == [("00:00:05", "a", 2), ("00:00:05", "b", 1)]


def test_files_with_old_dates_are_read(spark, feed, places):
    log, checkpoint = places
    path = feed("a")
    old = time.time() - 30 * 86400
    os.utime(f"{path}/000.txt", (old, old))
    feed("b")
    run.finish(run.start(words(file_lines(spark, path)), upserts.upsert_table(log, ["token"]), checkpoint), 120)
    assert rows(upserts.upserted(spark, log, ["token"])) == [("a", 1), ("b", 1)]


def test_table_of_a_job_without_input(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    folder = str(tmp_path / "job")
    run.finish(jobs.token_counts(file_lines(spark, str(tmp_path / "feed")), folder, every=None, state_partitions=1), 120)
    table = jobs.current_table(spark, folder, ["token"])
    assert table.columns == ["token", "n"] and table.count() == 0


def test_a_long_upserted_table_stays_short(spark, tmp_path):
    path = tmp_path / "log"
    write = upserts.upsert_table(str(path), ["k"], buckets=2, keep=3)
    for batch in range(20):
        write(spark.createDataFrame([(batch % 4, batch)], "k int, n int"), batch)
        assert len(list((path / "manifests").glob("*.json"))) <= 4
        assert len(list((path / "data").iterdir())) <= 2 * upserts.FAN * 3
    assert rows(upserts.upserted(spark, str(path), ["k"])) == [(0, 16), (1, 17), (2, 18), (3, 19)]
    named = upserts.manifest(spark, str(path)).files()
    assert all((path / name).exists() for name in named)


def test_drain_ends_while_data_keep_arriving(spark, tmp_path):
    lines = spark.readStream.format("rate").option("rowsPerSecond", 1000).load()
    query = run.start(
        lines.select(F.col("value")), sinks.batch_tables(str(tmp_path / "t"), lambda batch: batch),
        str(tmp_path / "c"), "0 seconds", state_partitions=1,
    )
    run.drain(query)
    assert not query.isActive


def test_bad_messages_are_kept_and_counted(spark, feed, tmp_path):
    """By the batch that has them, once, also where a batch is repeated; good counts do not change."""
    bad = ["{", "", '{"id":"a"}', '{"score":1}', '{"id":"a","score":"x"}', "[1]", "null"]
    feed('{"id":"a","score":1}', *bad)
    path = feed('{"id":"a","score":2}', '{"id":"b","score":1}', "{", "{")
    folder = str(tmp_path)

    def go():
        query = jobs.id_counts(file_lines(spark, path, files_per_batch=1), folder, every=None)
        run.finish(query, 300)
        return [p.observedMetrics["messages"] for p in query.recentProgress if "messages" in p.observedMetrics]

    seen = go()
    assert [(m["seen"], m["rejected"]) for m in seen if m["seen"]] == [(8, 7), (4, 2)]
    assert rows(jobs.current_table(spark, folder, ["id"])) == [("a", 2), ("b", 1)]
    found = rows(jobs.rejected_lines(spark, folder))
    assert [(b, text, n) for b, text, _, n in found] == sorted([*((0, text, 1) for text in bad), (1, "{", 2)], key=repr)
    assert {text: reason for _, text, reason, _ in found}["{"] == "unreadable message"
    assert {text: reason for _, text, reason, _ in found}['{"id":"a"}'] == "missing score"
    assert {text: reason for _, text, reason, _ in found}['{"score":1}'] == "missing id"
    feed('{"id":"b","score":5}', "}")
    go()
    assert rows(jobs.current_table(spark, folder, ["id"])) == [("a", 2), ("b", 2)]
    assert jobs.rejected_lines(spark, folder).agg(F.sum("n")).first()[0] == 10


def test_rejects_do_not_stay_in_the_state(spark, feed, tmp_path):
    for number in range(6):
        path = feed('{"id":"a","score":1}', *(f"bad {number} {i}" for i in range(50)))
        time.sleep(0.02)
    query = jobs.id_counts(file_lines(spark, path, files_per_batch=1), str(tmp_path), every=None, state_partitions=1)
    run.finish(query, 300)
    rows_held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(rows_held) <= 1 + 2 * 50 and jobs.rejected_lines(spark, str(tmp_path)).count() == 300
    assert rows(jobs.current_table(spark, str(tmp_path), ["id"])) == [("a", 6)]


def test_late_lines_are_kept_and_totals_add_up(spark, feed, tmp_path):
    """Lines of windows that are over go to the rejects; open windows go on; nothing else is held."""
    batches = [
        ["00:00:01 a b", "00:00:07 a"], ["00:00:03 a", "00:00:21 c"], ["00:00:04 a", "00:00:12 b", "00:00:22 c"],
        ["00:00:11 open", "00:01:00 d"], ["00:00:22 gone", "00:01:01 d", "........ when"],
    ]
    for texts in batches:
        path = feed(*texts)
        time.sleep(0.02)
    folder = str(tmp_path)
    lines = file_lines(spark, path, files_per_batch=1).select(
        F.expr("try_cast('2024-01-01 ' || substring(value, 1, 8) as timestamp_ntz)").alias("at"),
        F.substring("value", 10, 100).alias("value"),
    )
    run.finish(jobs.event_window_counts(lines, "at", folder, None, delay=timedelta(seconds=10)), 300)
    table = jobs.current_table(spark, folder, ["window_start", "token"])
    found = rows(table.select(F.date_format("window_start", "HH:mm:ss"), "token", "n"))
    assert found == sorted([
        ("00:00:00", "a", 2), ("00:00:00", "b", 1), ("00:00:05", "a", 1), ("00:00:10", "b", 1),
        ("00:00:10", "open", 1), ("00:00:20", "c", 2), ("00:01:00", "d", 2),
    ], key=repr)
    # The watermark is at 00:00:11 after the second batch, at 00:00:12 after the third, at 00:00:50 after the fourth.
    assert rows(jobs.rejected_lines(spark, folder)) == [
        (2, "a", "late", 1), (4, "gone", "late", 1), (4, "when", "no time", 1)
    ]


def test_windows_over_many_batches_hold_open_ones_alone(spark, feed, tmp_path):
    for number in range(12):
        path = feed(*(f"{number * 60 + i} x{i % 3}" for i in range(60)))
        time.sleep(0.02)
    folder = str(tmp_path)
    lines = file_lines(spark, path, files_per_batch=1).select(
        F.timestamp_seconds(F.split("value", " ")[0].cast("long")).cast("timestamp_ntz").alias("at"),
        F.split("value", " ")[1].alias("value"),
    )
    run.finish(jobs.event_window_counts(lines, "at", folder, None, delay=timedelta(seconds=20)), 300)
    path = jobs.table_path(folder)
    held = upserts.own_rows(spark, path, upserts.manifest(spark, path)).count()
    assert held <= 3 * (60 + 25) / 5 + 3
    assert jobs.current_table(spark, folder, ["window_start", "token"]).agg(F.sum("n")).first()[0] == 12 * 60


def test_each_whole_copy_is_the_total_so_far(spark, feed, tmp_path):
    total = {}
    wanted = []
    for number in range(3):
        ids = ["a"] * (number + 1) + [f"only{number}"]
        path = feed(*(f'{{"id":"{i}","score":1}}' for i in ids), "bad")
        time.sleep(0.02)
        for i in ids:
            total[i] = total.get(i, 0) + 1
        wanted.append(sorted(total.items(), key=repr))
    lines = file_lines(spark, path, files_per_batch=1)
    query = jobs.all_id_counts(lines, str(tmp_path), every=None)
    run.finish(query, 300)
    path = jobs.table_path(str(tmp_path))
    assert [rows(upserts.whole_copy(spark, path, n)) for n in upserts.copies(spark, path)] == wanted
    assert rows(upserts.whole_copy(spark, path)) == wanted[-1]
    with pytest.raises(FileNotFoundError):
        upserts.whole_copy(spark, path, 7)


def test_old_whole_copies_go(spark, tmp_path):
    path = tmp_path / "t"
    write = upserts.whole_table(str(path), keep=2)
    for batch in range(5):
        write(spark.createDataFrame([(batch,)], "n int"), batch)
        write(spark.createDataFrame([(batch,)], "n int"), batch)
    assert upserts.copies(spark, str(path)) == [3, 4] and len(list((path / "data").iterdir())) <= 4
    assert [rows(upserts.whole_copy(spark, str(path), n)) for n in (3, 4)] == [[(3,)], [(4,)]]


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_sketches_of_shows(spark, feed, tmp_path, files_per_batch):
    """The same over one and several batches, exact for few codes, and mergeable."""
    for number in range(3):
        path = feed(line(*(ticket(showCode=f"S{i}", hallCode=str(i % 2)) for i in range(number, number + 40))))
        time.sleep(0.02)
    lines = file_lines(spark, path, files_per_batch=files_per_batch)
    run.finish(jobs.distinct_shows(lines, str(tmp_path), every=None), 300)
    table = jobs.current_table(spark, str(tmp_path), SHOWING_KEY)
    assert rows(sales.estimated_shows(table).select("hall", "show_codes")) == [("0", 21), ("1", 21)]
    assert rows(sales.estimated_shows(table, "cinema")) == [("139", 42)]


def test_error_of_the_sketches(spark):
    many = spark.range(300_000).selectExpr(
        "'c' as cinema", "cast(id % 2 as string) as hall", "'d' as show_date", "'t' as show_time", "'m' as movie",
        "concat('S', id) as show_code",
    )
    sketches = sales.show_sketches(many)
    for row in sales.estimated_shows(sketches).collect():
        assert abs(row.show_codes / 150_000 - 1) < 0.05
    assert abs(sales.estimated_shows(sketches, "cinema").first().show_codes / 300_000 - 1) < 0.05
