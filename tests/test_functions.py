from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from foyer.functions import pay, showing, text
from foyer.functions.sql import register_functions


@pytest.fixture
def evaluate(spark):
    """The value of an expression over one row of the given columns."""
    def run(expression, schema="x int", *row):
        return spark.createDataFrame([row or (0,)], schema).select(expression).first()[0]

    return run


@pytest.mark.parametrize("value, expected", [
    ("a,b,,", ["a", "b"]), (",", []), (",,,", []), ("", [""]), (",a", ["", "a"]),
    ("a,,b", ["a", "", "b"]), ("a", ["a"]), (" a ,b ", [" a ", "b "]),
])
def test_tokens_drop_trailing_empties(evaluate, value, expected):
    assert evaluate(text.tokens(F.col("s"), ","), "s string", value) == expected


def test_tokens_by_regex_character_and_null(evaluate):
    assert evaluate(text.tokens(F.col("s"), "|"), "s string", "a||b|") == ["a", "", "b"]
    assert evaluate(text.tokens(F.col("s"), "."), "s string", "a.b.") == ["a", "b"]
    assert evaluate(text.tokens(F.col("s"), "|"), "s string", None) is None


def test_space_tokens(evaluate):
    assert evaluate(text.space_tokens(F.col("s")), "s string", "a b\tc  d\n\r ") == ["a", "b", "c", "", "d"]
    assert evaluate(text.space_tokens(F.col("s")), "s string", " \t") == []


def test_full_trim_strips_control_characters(evaluate):
    assert evaluate(text.full_trim(F.col("s")), "s string", "\n\t a b \x00\r") == "a b"


def test_line_field(evaluate):
    line = "t\u0001[1]\u0001 s "
    assert [evaluate(text.line_field(F.col("s"), i), "s string", line) for i in range(4)] == ["t", "[1]", " s ", None]


def test_has_tag(evaluate):
    tagged = {line: evaluate(text.has_tag(F.col("s"), "t"), "s string", line) for line in ("t\u0001x", "tt\u0001x", "t", "")}
    assert list(tagged.values()) == [True, False, False, False]


def test_json_field_text_tells_null_from_absent(evaluate):
    body = '{"a": "x\\"y", "n": 7, "z": null, "o": {"k": "v"}}'
    got = {name: evaluate(text.json_field_text(F.col("s"), name), "s string", body) for name in "anzo"}
    assert got == {"a": "xy", "n": "7", "z": "null", "o": "{k:v}"}
    assert evaluate(text.json_field_text(F.col("s"), "missing"), "s string", body) is None


def test_showing_key_golden(spark):
    row = spark.createDataFrame(
        [("139", "8", "2019-12-19 17:20:00", "051402342019")], "c string, h string, s string, m string"
    ).select(*showing.showing_key(*map(F.col, "chsm"))).first()
    assert tuple(row) == ("139", "8", "2019-12-19", "17:20", "05102342019")
    assert row.__fields__ == list(showing.SHOWING_KEY)


@pytest.mark.parametrize("start, day", [
    ("2019-12-31 05:00:00", "2019-12-30"), ("2019-12-31 06:00:00", "2019-12-31"),
    ("2020-03-01 00:00:00", "2020-02-29"), ("2020-01-01 05:59:59", "2019-12-31"),
    ("2019-12-31 24:30:00", None), ("-", None), ("2019-12-31 05:00:00.5", None),
    ("2019-12-31T05:00:00", None), ("2019-12-31", None), (None, None), ("2019-02-30 07:00:00", None),
])
def test_business_date(evaluate, start, day):
    assert evaluate(showing.business_date(F.col("s")), "s string", start) == day


def test_business_date_ignores_daylight_saving(spark, evaluate):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert evaluate(showing.business_date(F.col("s")), "s string", "2020-03-08 06:30:00") == "2020-03-08"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_clock_part(evaluate):
    assert evaluate(showing.clock_part(F.col("s")), "s string", "2019-12-31 05:00:00") == "05:00:00"
    assert evaluate(showing.clock_part(F.col("s")), "s string", "2019-12-31") is None


def test_relative_dates(evaluate):
    clock = F.lit("2019-12-31 23:05:06").cast("timestamp")
    assert evaluate(showing.today(clock)) == "2019-12-31"
    assert evaluate(showing.tomorrow(clock)) == "20200101"
    assert evaluate(showing.batch_stamp(F.lit(1577833506999))) == "20191231230506"


PAY = "items array<struct<payCode:string,payValue:bigint>>"
LOOSE = "items array<struct<payCode:string,payValue:string>>"


@pytest.mark.parametrize("items, total", [
    ([("a", 3000), ("b", 4000)], 7000), ([], 0), ([("a", None)], None), (None, None),
])
def test_pay_total(evaluate, items, total):
    assert evaluate(pay.pay_total(F.col("items")), PAY, items) == total


@pytest.mark.parametrize("items, total", [
    ([("a", "3000"), ("b", None)], 3000), ([], 0), ([("a", "30.5")], None), ([("a", "x")], None),
])
def test_loose_pay_total(evaluate, items, total):
    assert evaluate(pay.loose_pay_total(F.col("items")), LOOSE, items) == total


ARRAYS = "codes array<string>, amounts array<bigint>"
MODES = [
    (["card", "cash"], [3000, 4000], "cash"), (["a", "b", "c"], [5, 9, 9], "b"),
    (["a", "b"], [0, -1], "a"), (["a", "b"], [None, 2], "b"), ([], [], None), (["a"], [], "a"),
]


@pytest.mark.parametrize("codes, amounts, mode", MODES)
def test_dominant_pay_code(evaluate, codes, amounts, mode):
    expression = pay.dominant_pay_code(F.col("codes"), F.col("amounts"))
    assert evaluate(expression, ARRAYS, codes, amounts) == mode


def test_array_total(evaluate):
    assert evaluate(pay.array_total(F.col("v")), "v array<bigint>", [1, None, 5]) == 6
    assert evaluate(pay.array_total(F.col("v")), "v array<bigint>", None) is None


@pytest.mark.parametrize("cents, yuan", [(14000, 140.0), (-199, -1.0), (199, 1.0), (99, 0.0)])
def test_whole_yuan_cuts_cents(evaluate, cents, yuan):
    assert evaluate(pay.whole_yuan(F.col("c")), "c bigint", cents) == yuan


def test_sql_functions(spark):
    register_functions(spark)
    one = spark.sql(
        "SELECT getArraySum(array(1L, null, 5L)), str_to_jsonArray('[{\"a\": 1}, {\"b\": [2]}]'),"
        " str_to_jsonArray('[]')"
    ).first()
    assert tuple(one) == (6, ['{"a":1}', '{"b":[2]}'], [])
    frame = spark.createDataFrame([(c, a) for c, a, _ in MODES], ARRAYS)
    got = [row[0] for row in frame.selectExpr("getPayMode(codes, amounts)").collect()]
    assert got == [mode for *_, mode in MODES]
