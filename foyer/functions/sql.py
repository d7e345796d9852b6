"""The array functions under names usable from SQL text.

They are SQL functions, so Catalyst inlines their bodies: no Python at run time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "str_to_jsonArray(body STRING) RETURNS ARRAY<STRING>": "from_json(body, 'array<string>')",
    "getArraySum(items ARRAY<BIGINT>) RETURNS BIGINT": (
        "aggregate(items, 0L, (total, item) -> total + coalesce(item, 0L))"
    ),
    "getPayMode(codes ARRAY<STRING>, amounts ARRAY<BIGINT>) RETURNS STRING": (
        "get(codes, if(array_max(amounts) > 0,"
        " cast(array_position(amounts, array_max(amounts)) as int) - 1, 0))"
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Make the functions callable from ``spark.sql`` in this session."""
    for head, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
