"""Aggregates over tickets. All pre-aggregate before the shuffle, so a hot key is cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foyer.functions.showing import SHOWING_KEY

BOX_OFFICE_KEY = ("date_id", "show_time", "cinemaInnerCode", "movieCode")


def sales_by_showing(tickets: DataFrame) -> DataFrame:
    """Tickets and cents per showing; ``shows`` is 1, for one showing per row."""
    totals = tickets.groupBy(*SHOWING_KEY).agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("amount").alias("amount")
    )
    return totals.withColumn("shows", F.lit(1))


def distinct_shows(tickets: DataFrame, exact: bool = True) -> DataFrame:
    """Number of different show codes per showing key. A stream can only estimate it."""
    number = F.count_distinct("show_code") if exact else F.approx_count_distinct("show_code")
    return tickets.groupBy(*SHOWING_KEY).agg(number.alias("show_codes"))


#: Binary logarithm of a sketch's places: about 1.6 % standard error, and exact for small numbers.
SKETCH_PLACES = 12


def show_sketches(tickets: DataFrame) -> DataFrame:
    """A sketch of the different show codes per showing key, of a table or a running one of a stream."""
    return tickets.groupBy(*SHOWING_KEY).agg(F.hll_sketch_agg("show_code", SKETCH_PLACES).alias("show_sketch"))


def estimated_shows(sketches: DataFrame, *keys: str) -> DataFrame:
    """The number of different show codes per showing key or, by merging sketches, per some of its columns."""
    merged = sketches.groupBy(*(keys or SHOWING_KEY)).agg(F.hll_union_agg("show_sketch").alias("merged"))
    return merged.withColumn("show_codes", F.hll_sketch_estimate("merged")).drop("merged")


def _times(rows: Column, factor: Column) -> Column:
    # A key with a third of a huge table overflows a bigint here, a decimal it does not.
    wide = "decimal(38,0)"
    return (rows.cast("decimal(19,0)") * factor.cast("decimal(19,0)")).cast(wide)


def join_totals(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Rows, and sum of the right side's ``measure``, of ``left JOIN right USING (keys)``.

    The keys need not be unique: m rows on the left and n on the right make m x n pairs.
    The pairs are counted, not made. Each side shrinks to a row per key first, and the
    join of the two reuses their partitioning.
    """
    lefts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("left_rows"))
    rights = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("right_rows"), F.sum(measure).alias("right_sum")
    )
    return lefts.join(rights, list(keys)).select(
        *keys,
        _times(F.col("left_rows"), F.col("right_rows")).alias("pairs"),
        _times(F.col("left_rows"), F.col("right_sum")).alias(measure),
    )


def self_join_totals(rows: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """``join_totals(rows, rows, ...)`` in one pass over the rows."""
    count = F.count(F.lit(1))
    return rows.groupBy(*keys).agg(
        _times(count, count).alias("pairs"), _times(count, F.sum(measure)).alias(measure)
    )


def box_office(tickets: DataFrame) -> DataFrame:
    """Signed ticket count and cents per business day, show time, cinema and movie."""
    return tickets.groupBy(*BOX_OFFICE_KEY).agg(
        F.sum("ticket_num").alias("ticket_num"), F.sum("ticket_amt").alias("ticket_amt")
    )


def opening_balances(table: DataFrame) -> DataFrame:
    """Opening balances with the key and measures of ``box_office``: one row per key, ``-`` for a null in the key."""
    rows = table.select(
        *(F.coalesce(F.col(key).cast("string"), F.lit("-")).alias(key) for key in BOX_OFFICE_KEY),
        *(F.coalesce(F.col(name).cast("bigint"), F.lit(0)).alias(name) for name in ("ticket_num", "ticket_amt")),
    )
    return box_office(rows)


def seeded_box_office(tickets: DataFrame, balances: DataFrame) -> DataFrame:
    """As ``box_office``, starting from opening balances; both are tables.

    Only keys with a ticket come out; a key that has a balance and no ticket does not.
    """
    fed = tickets.select(*BOX_OFFICE_KEY, "ticket_num", "ticket_amt", F.lit(True).alias("fed"))
    both = fed.unionByName(opening_balances(balances).withColumn("fed", F.lit(False)))
    totals = both.groupBy(*BOX_OFFICE_KEY).agg(
        F.sum("ticket_num").alias("ticket_num"), F.sum("ticket_amt").alias("ticket_amt"),
        F.max("fed").alias("fed"),
    )
    return totals.where("fed").drop("fed")


def count_by_cinema(orders: DataFrame) -> DataFrame:
    """Orders per cinema."""
    return orders.groupBy("cinemaInnerCode").agg(F.count(F.lit(1)).alias("cnt"))
