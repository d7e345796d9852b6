"""What identifies a showing: codes, show date and time, business day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foyer.functions.text import unquoted

SHOWING_KEY = ("cinema", "hall", "show_date", "show_time", "movie")


def base_movie_code(code: Column) -> Column:
    """The movie code without its 4th character, which tells the release version."""
    return F.concat(F.substring(code, 1, 3), F.substr(code, F.lit(5)))


def showing_key(cinema: Column, hall: Column, start: Column, movie: Column) -> list[Column]:
    """The five columns that identify a showing."""
    start = unquoted(start)
    return [
        unquoted(cinema).alias("cinema"),
        unquoted(hall).alias("hall"),
        F.substring(start, 1, 10).alias("show_date"),
        F.substring(start, 12, 5).alias("show_time"),
        base_movie_code(unquoted(movie)).alias("movie"),
    ]


def naive_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as a zone-free timestamp; NULL for any other form."""
    shaped = (F.length(text) == 19) & (F.substring(text, 11, 1) == " ")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def business_date(start: Column) -> Column:
    """Business day as ``yyyy-MM-dd``: a showing before 06:00 belongs to the day before."""
    return (naive_time(start) - F.expr("interval 6 hours")).cast("date").cast("string")


def clock_part(start: Column) -> Column:
    """The part after the first space: the time of day."""
    return F.get(F.split(start, " "), F.lit(1))


def today(clock: Column) -> Column:
    """``yyyy-MM-dd`` of the given clock, ``F.current_timestamp()`` in production."""
    return F.date_format(clock, "yyyy-MM-dd")


def tomorrow(clock: Column) -> Column:
    """``yyyyMMdd`` of the day after the given clock."""
    return F.date_format(F.date_add(clock.cast("date"), 1), "yyyyMMdd")


def batch_stamp(millis: Column) -> Column:
    """``yyyyMMddHHmmss`` of a batch time in milliseconds."""
    return F.date_format(F.timestamp_millis(millis), "yyyyMMddHHmmss")
