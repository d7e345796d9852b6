from __future__ import annotations

import json

import pytest
from conftest import line, rows, ticket
from pyspark.sql import functions as F

from foyer.functions.showing import SHOWING_KEY
from foyer.operators import sales, tickets
from foyer.operators.counts import flat_elements, id_counts, id_messages
from foyer.operators.rejects import kept, rejected

KEY = ("139", "8", "2019-12-19", "17:20", "05102342019")
BOX_KEY = ("2019-12-19", "17:20:00", "139", "051402342019")


def test_sales_golden(golden):
    assert rows(sales.sales_by_showing(kept(tickets.sale_tickets(golden)))) == [(*KEY, 2, 14000, 1)]


def test_pairs_golden(golden):
    good = kept(tickets.sale_tickets(golden))
    assert rows(sales.self_join_totals(good, SHOWING_KEY, "amount")) == [(*KEY, 4, 28000)]


def test_presale_golden(golden):
    signed = kept(tickets.presale_tickets(golden, "2019-12-01"))
    assert rows(sales.box_office(signed)) == [(*BOX_KEY, 0, 0)]
    assert rows(sales.box_office(kept(tickets.presale_tickets(golden, "2019-12-20")))) == []


def test_distinct_texts_golden(golden):
    data = golden.select(F.split("value", "\u0001")[1].alias("data"))
    texts = tickets.explode_ticket_texts(data.unionAll(data))
    assert texts.count() == 4 and texts.distinct().count() == 2


def test_array_of_several_and_empty_array(lines):
    feed = lines(line(ticket(), ticket(hallCode="9")), line())
    halls = kept(tickets.sale_tickets(feed)).select("hall")
    assert rows(halls) == [("8",), ("9",)]


def test_sign_rule(lines):
    feed = lines(*(line(ticket(isRefund=mark)) for mark in ("N", "Y", "X", None, ...)))
    nums = kept(tickets.presale_tickets(feed, "2019-12-01")).select("ticket_num", "ticket_amt")
    assert rows(nums) == sorted([(1, 7000)] + [(-1, -7000)] * 4, key=repr)


def test_presale_takes_tagged_lines_quoted_values_and_defaults(lines):
    items = [{"payCode": "a", "payValue": "30"}, {"payCode": "b"}]
    feed = lines(
        line(ticket(ticketPayInfo=items, cinemaInnerCode=..., movieCode=...)), line(ticket(), topic="other")
    )
    good = kept(tickets.presale_tickets(feed, "2019-12-01"))
    assert rows(good) == [("2019-12-19", "17:20:00", "-", "-", 1, 30)]


def test_early_showing_belongs_to_the_day_before(lines):
    feed = lines(line(ticket(movieShowStartTime="2019-12-01 05:30:00")), line(ticket(movieShowStartTime="2019-12-01 06:00:00")))
    days = kept(tickets.presale_tickets(feed, "2019-12-01")).select("date_id", "show_time")
    assert rows(days) == [("2019-12-01", "06:00:00")]


BAD_SALES = {
    "unreadable ticket": "topic\u0001[{not json\u0001time",
    "missing cinemaInnerCode": line(ticket(cinemaInnerCode=...)),
    "missing hallCode": line(ticket(hallCode=None)),
    "short movieShowStartTime": line(ticket(movieShowStartTime="2019")),
    "short movieCode": line(ticket(movieCode="051")),
    "missing ticketPayInfo": line(ticket(ticketPayInfo=...)),
    "unreadable payValue": line(ticket(ticketPayInfo=[{"payCode": "a", "payValue": "30"}])),
}


def test_sale_rejects_carry_line_and_reason(lines):
    found = tickets.sale_tickets(lines(line(ticket()), "no fields", *BAD_SALES.values()))
    assert rows(kept(found).select("amount")) == [(7000,)]
    expected = {(text, reason) for reason, text in BAD_SALES.items()} | {("no fields", "unreadable ticket")}
    assert set(rows(rejected(found))) == expected


def test_a_bad_ticket_leaves_the_others_of_its_line(lines):
    items = [{"payCode": "a", "payValue": "30"}]
    found = tickets.sale_tickets(lines(line(ticket(hallCode="7"), ticket(ticketPayInfo=items), ticket(), None)))
    assert rows(kept(found).select("hall", "amount")) == [("7", 7000), ("8", 7000)]
    assert [reason for _, reason in rows(rejected(found))] == ["unreadable payValue", "unreadable ticket"]


def test_a_lone_object_counts_as_an_array_of_one(lines):
    body = json.dumps(ticket())
    assert rows(kept(tickets.sale_tickets(lines(f"t\u0001{body}\u0001s"))).select("amount")) == [(7000,)]


def test_presale_rejects(lines):
    bad = {
        "unreadable movieShowStartTime": line(ticket(movieShowStartTime="2019-12-19 24:30:00")),
        "missing ticketPayInfo": line(ticket(ticketPayInfo=...)),
        "unreadable payValue": line(ticket(ticketPayInfo=[{"payValue": "30.5"}])),
    }
    found = tickets.presale_tickets(lines(*bad.values()), "2019-12-01")
    assert rows(kept(found)) == []
    assert set(rows(rejected(found))) == {(text, reason) for reason, text in bad.items()}


def test_strict_fails_on_a_reject(lines):
    found = tickets.sale_tickets(lines(line(ticket()), BAD_SALES["short movieCode"]))
    with pytest.raises(Exception, match="rejected row: short movieCode"):
        kept(found, strict=True).collect()
    assert kept(tickets.sale_tickets(lines(line(ticket()))), strict=True).count() == 1


@pytest.fixture
def pairs(spark):
    left = spark.createDataFrame([("a",)] * 40 + [("b",)] * 3 + [("c",)], "k string")
    right = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 7), ("b", -9), ("d", 1)], "k string, amount bigint")
    return left, right


def test_join_totals_equals_the_joined_rows(pairs):
    left, right = pairs
    joined = left.join(right, "k").groupBy("k").agg(F.count(F.lit(1)).alias("pairs"), F.sum("amount").alias("amount"))
    assert rows(sales.join_totals(left, right, ["k"], "amount")) == rows(joined)
    twin = right.join(right.select("k"), "k").groupBy("k").agg(F.count(F.lit(1)), F.sum("amount"))
    assert rows(sales.self_join_totals(right, ["k"], "amount")) == rows(twin)


def test_a_hot_key_is_summed_not_paired(spark):
    """A third of the rows share a key: its ten thousand million pairs could not be made."""
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    data = spark.range(300_000).select(hot.alias("k"), F.lit(2).cast("bigint").alias("amount"))
    for totals in (sales.self_join_totals(data, ["k"], "amount"), sales.join_totals(data, data, ["k"], "amount")):
        found = totals.where("k = 'hot'").first()
        assert (int(found["pairs"]), int(found["amount"])) == (10**10, 2 * 10**10)
        assert totals.count() == 200_001


def test_pairs_of_a_huge_key_do_not_overflow(spark):
    row = spark.range(1).select(
        sales._times(F.lit(4 * 10**11), F.lit(4 * 10**11)).alias("pairs"),
        sales._times(F.lit(4 * 10**11), F.lit(-4 * 10**18)).alias("amount"),
    ).first()
    assert tuple(map(int, row)) == (16 * 10**22, -16 * 10**29)


def test_seeded_box_office_puts_out_fed_keys_only(spark):
    columns = "date_id string, show_time string, cinemaInnerCode string, movieCode string, ticket_num bigint, ticket_amt bigint"
    seed = spark.createDataFrame([("d", "t", "1", "m", 10, 1000), ("d", "t", "2", "m", 5, 50)], columns)
    fed = spark.createDataFrame([("d", "t", "1", "m", 1, 7), ("d", "t", "3", "m", -1, -7)], columns)
    assert rows(sales.seeded_box_office(fed, seed)) == [("d", "t", "1", "m", 11, 1007), ("d", "t", "3", "m", -1, -7)]


def test_distinct_shows(lines):
    feed = lines(*(line(ticket(showCode=code)) for code in ("x", "x", "y")))
    good = kept(tickets.sale_tickets(feed, shows=True))
    assert rows(sales.distinct_shows(good)) == rows(sales.distinct_shows(good, exact=False)) == [(*KEY, 2)]


def test_schedule_messages(lines):
    feed = lines('t\u0001{"syncType":"Show_Details","a":1}', 't\u0001{"syncType":"Film"}', "t\u0001{}", "t")
    assert rows(kept(tickets.schedule_messages(feed))) == [('{"syncType":"Show_Details","a":1}',)]


def test_id_messages_need_both_fields(lines):
    feed = lines('{"id":"a","score":1}', '{"id":"a","score":2,"x":0}', '{"id":"b"}', '{"score":3}', "junk")
    assert rows(id_counts(kept(id_messages(feed)))) == [("a", 2)]


def test_flat_elements(spark):
    nested = spark.createDataFrame([([[11, 22, 33], [33, 44], [55, 66]],)], "n array<array<int>>")
    assert [row[0] for row in flat_elements(nested, "n").collect()] == [11, 22, 33, 33, 44, 55, 66]
