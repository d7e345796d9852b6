"""Groups whose members lie in several components: who has yet to meet whom, dealt to parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.llm.common import written

#: Outsiders that meet a group in one part.
PART = 2048


def dealt(rows: DataFrame, roots: DataFrame, group: str, fields: Sequence[str], size: int = PART) -> DataFrame:
    """Rows (``part``, ``outside``, fields) by part: its outsiders (``outside`` 0), then the group's members (1).

    ``rows`` have a ``group`` and a ``node``; ``root``, which fields may name, is the node's component.
    Only groups with several components come. The outsiders are the members outside the component
    that has most of the group: any pair of a group in different components has one of them. They are dealt to
    parts by hash, and the members go to each part.
    """
    now = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = now.groupBy(group, "root").agg(F.count("*").alias("rows"))
    home = counts.groupBy(group).agg(
        F.max_by("root", F.struct("rows", "root")).alias("home"), F.sum("rows").alias("all"), F.max("rows").alias("most")
    ).where("all > most")
    parts = home.select(group, "home", F.ceil((F.col("all") - F.col("most")) / size).cast("int").alias("parts"))
    now = now.join(written(parts, "outsider-parts"), group)
    piece = F.pmod(F.hash("node"), F.col("parts"))
    outsiders = now.where("root <> home").select(F.xxhash64(group, piece).alias("part"), F.lit(0).alias("outside"), *fields)
    members = now.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.xxhash64(group, "piece").alias("part"), F.lit(1).alias("outside"), *fields
    )
    return outsiders.union(members).repartition("part").sortWithinPartitions("part", "outside")


class Rows:
    """A batch's columns as arrays; the last one, of equally long bytes, as rows of a matrix."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        *plain, marks = (batch.column(i) for i in range(batch.num_columns))
        self.columns = [column.to_numpy(zero_copy_only=False) for column in plain]
        self.marks = np.frombuffer(b"".join(marks.to_pylist()), np.uint8).reshape(-1, width)

    def runs(self) -> Iterator[tuple[int, int]]:
        """Where the first column's runs of equal values begin and end."""
        first = self.columns[0]
        heads = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        return zip(heads.tolist(), [*heads[1:].tolist(), len(first)], strict=True)
