"""Sums and choices over the pay items of a ticket. Amounts are integer cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def pay_total(items: Column) -> Column:
    """Sum of ``payValue``; 0 for no items, NULL if an item has no value."""
    return F.aggregate(items, _zero(), lambda total, item: total + item["payValue"])


def loose_pay_total(items: Column, field: str = "payValue") -> Column:
    """Sum of a text field over the items; absent counts 0, NULL if one is no integer."""
    def add(total: Column, item: Column) -> Column:
        return total + F.coalesce(item[field], F.lit("0")).try_cast("bigint")

    return F.aggregate(items, _zero(), add)


def array_total(values: Column) -> Column:
    """Sum of an array of integers, NULL elements counting 0."""
    return F.aggregate(values, _zero(), lambda total, value: total + F.coalesce(value, _zero()))


def dominant_pay_code(codes: Column, values: Column) -> Column:
    """The code at the first largest value above 0, else the first code; NULL if none."""
    best = F.array_max(values)
    place = F.when(best > 0, F.array_position(values, best) - 1).otherwise(F.lit(0))
    return F.get(codes, place.cast("int"))


def whole_yuan(cents: Column) -> Column:
    """Cents to currency units as a double; the cents are cut off, not rounded."""
    return F.call_function("div", cents, F.lit(100)).cast("double")
