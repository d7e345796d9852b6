from __future__ import annotations

import pytest

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs; the other columns are filled in."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def make(*rows, **extra):
        full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
        frame = spark.createDataFrame(full, schema)
        for name, value in extra.items():
            from pyspark.sql import functions as F

            frame = frame.withColumn(name, F.lit(value))
        return frame

    return make


def texts(spark, sf_dir):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def lowered(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})
