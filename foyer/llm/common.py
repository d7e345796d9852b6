"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foyer.session import shared_folder

#: White space that separates words, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, whole."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def named(column: str) -> Column:
    """A column by its exact name, dots and back quotes included."""
    return F.col("`{}`".format(column.replace("`", "``")))


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(named(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text: longest runs without white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda word: word != "")


def key_hash(column: str) -> Column:
    """crc32 of a column as decimal text; null counts as the empty text."""
    return F.crc32(F.coalesce(named(column).cast("string"), F.lit("")).cast("binary"))


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: later steps start from these files.

    A lost executor then costs a re-read, and no step is computed twice.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def most_frequent(counts: DataFrame, key: str, n: str, most: int) -> DataFrame:
    """The rows of ``counts`` above the least count, in steps of an eighth of its binary logarithm,
    that at most ``most`` rows reach. One number per step reaches the driver.
    """
    step = F.floor(8 * F.log2(named(n).cast("double"))).cast("int")
    sizes = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    least, total = None, 0
    for at, rows in sizes:
        total += rows
        if total > most:
            break
        least = at
    return counts.select(key, n).where(F.lit(False) if least is None else step >= least)
