"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from foyer.functions.text import line_field
from foyer.operators import sales, tickets
from foyer.operators.rejects import kept
from foyer.plans import batch, inputs
from foyer.plans.batch import QUERIES


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan(query(spark, sf_dir)) for name, query in QUERIES.items()}


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(plans, name):
    assert not re.search(r"Cartesian|NestedLoop|Python|MapInArrow|ObjectHashAggregate|SortAggregate", plans[name])


# Shuffles by key; spreading a small scan is by round robin and does not count.
SHUFFLES = {
    "ticket_sales_batch": 1, "distinct_shows_per_key": 2, "fanout_join_sales": 1, "fanout_join_two_sides": 2,
    "presale_box_office": 1, "landed_log_distinct_orders": 1, "landed_orders_count_by_cinema": 2,
    "orders_json_count_by_cinema": 1, "batch_word_count": 1, "regex_space_token_count": 1, "csv_token_count": 1,
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_shuffles(plans, name):
    assert plans[name].count("Exchange hashpartitioning") == SHUFFLES.get(name, 0)
    if name in SHUFFLES:
        assert "functions=[]" in plans[name] or "partial_" in plans[name]


def test_each_array_is_parsed_once(plans):
    for name in ("landed_orders_count_by_cinema", "landed_log_distinct_orders", "ticket_sales_batch"):
        assert plans[name].count("from_json(ArrayType") == 1, name


def test_narrow_scans(plans):
    assert "ReadSchema: struct<cinemaInnerCode:string>" in plans["orders_json_count_by_cinema"]
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plans["catalog_point_filter"]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plans["business_date"]


def test_the_line_does_not_travel_with_each_ticket(spark, sf_dir):
    lines = spark.read.schema("value string").text(inputs.ticket_files(spark, sf_dir))
    for frame in (tickets.sale_tickets(lines), tickets.presale_tickets(lines, batch.SINCE)):
        generate = next(row for row in plan(kept(frame)).splitlines() if "Generate explode" in row)
        assert re.search(r"\[null\]\)\), false, \[ticket#\d+\]", generate)


def test_join_of_large_sides_reuses_their_partitioning(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = batch.fanout_join_two_sides(spark, sf_dir)
        text = plan(rows)
        rows.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" in text and text.count("Exchange") == 2


def test_one_pass_for_joined_twins(spark, sf_dir):
    assert plan(batch.fanout_join_sales(spark, sf_dir)).count("FileScan") == 1


def test_feed_follows_its_table(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    path = str(tmp_path / "lineitem.parquet")
    rows.limit(100).write.parquet(path)
    before = batch.QUERIES["explode_ticket_array"](spark, str(tmp_path)).count()
    rows.limit(1000).write.mode("append").parquet(path)
    assert batch.QUERIES["explode_ticket_array"](spark, str(tmp_path)).count() > 5 * before


def test_pair_totals_beyond_a_bigint(spark):
    hot = spark.range(4_000_000).selectExpr("'a' as k", "3000000000L as amount")
    pairs = sales.self_join_totals(hot, ["k"], "amount").first()
    assert int(pairs["pairs"]) == 16 * 10**12 and int(pairs["amount"]) == 4_000_000**2 * 3 * 10**9 > 2**63


@pytest.mark.parametrize("name", ["showing_key", "ticket_sales_batch", "presale_box_office"])
def test_the_ticket_feed_is_derived_in_the_plan_not_written(plans, name):
    # A written copy of the feed is many times the table it comes from.
    assert "FileScan text" not in plans[name] and "lineitem.parquet" in plans[name]


def test_the_ticket_stream_reads_the_table(spark, sf_dir):
    lines = inputs.ticket_stream(spark, sf_dir)
    assert lines.isStreaming and lines.columns == ["value"]
    assert sorted(inputs.ticket_feed(spark, sf_dir).collect()) == sorted(
        spark.read.schema("value string").text(inputs.ticket_files(spark, sf_dir)).collect()
    )


def test_filters_do_not_derive_the_lines_of_the_feed_again(spark, sf_dir):
    earlier = inputs.ticket_feed(spark, sf_dir).where(line_field(F.col("value"), 2) < batch.OPENED)
    text = plan(kept(tickets.presale_tickets(earlier, batch.SINCE)))
    assert text.count("StructsToJsonEvaluator") == 1


@pytest.mark.parametrize("name", ["landed_log_distinct_orders", "landed_orders_count_by_cinema"])
def test_the_landed_log_is_derived_in_the_plan_not_written(plans, name):
    assert "FileScan text" not in plans[name] and "lineitem.parquet" in plans[name]


def test_the_derived_log_equals_the_landed_files(spark, sf_dir):
    from foyer.sources.files import landed_log, log_fields

    assert sorted(log_fields(inputs.landed_log(spark, sf_dir)).collect()) == sorted(
        landed_log(spark, inputs.landed_files(spark, sf_dir)).collect()
    )
