"""Bad rows: kept out of results, never silently.

A step that can meet bad rows adds ``reject_reason``, NULL for a good row. The caller
then takes the good rows, the rejects, or has the job fail on the first reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def reject_reason(**bad: Column) -> Column:
    """The name of the first condition that holds, with spaces for underscores."""
    named = [F.when(condition, F.lit(name.replace("_", " "))) for name, condition in bad.items()]
    return F.coalesce(*named).alias(REASON)


def kept(rows: DataFrame, strict: bool = False) -> DataFrame:
    """The good rows. ``strict`` makes a bad row fail the job instead of leaving it out."""
    good = F.col(REASON).isNull()
    if strict:
        failure = F.raise_error(F.concat(F.lit("rejected row: "), F.col(REASON)))
        good = F.when(good, F.lit(True)).otherwise(failure.cast("boolean"))
    return rows.where(good).drop(REASON, "line")


def rejected(rows: DataFrame) -> DataFrame:
    """The source line and reason of each bad row."""
    return rows.where(F.col(REASON).isNotNull()).select("line", REASON)


def counted(rows: DataFrame, name: str = "rows") -> DataFrame:
    """Count rows seen and rejected in passing; a stream reports them in its progress."""
    return rows.observe(
        name, F.count(F.lit(1)).alias("seen"), F.count(REASON).alias("rejected")
    )


def parted(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The good rows and the rejects of a batch, by one pass that writes both below ``path``."""
    spark = rows.sparkSession
    bad = F.col(REASON).isNotNull()
    split = rows.withColumn("line", F.when(bad, F.col("line"))).withColumn("rejected", bad)
    split.write.partitionBy("rejected").parquet(path)
    back = spark.read.schema(split.schema).parquet(path)
    return kept(back.where("not rejected").drop("rejected")), rejected(back.where("rejected"))
