"""Shapes of the sink tables: what a running result looks like where it is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.functions.pay import whole_yuan
from foyer.functions.showing import SHOWING_KEY
from foyer.functions.text import full_trim


def trimmed_tokens(tokens: DataFrame) -> DataFrame:
    """Tokens as the word table stores them. Trim before counting: two spellings of one
    stored key then add up instead of replacing each other."""
    return tokens.select(full_trim(F.col("token")).alias("token"))


def sales_table(totals: DataFrame) -> DataFrame:
    """Running sales with the amount in whole currency units."""
    return totals.select(*SHOWING_KEY, "tickets", whole_yuan(F.col("amount")).alias("amount"))
