"""Where streams write, besides the upserted table: a table per batch, JDBC, console."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from foyer.streaming.files import write_even
from foyer.streaming.run import BatchWriter

def batch_tables(path: str, step: Callable[[DataFrame], DataFrame]) -> BatchWriter:
    """Apply ``step`` to each batch on its own and write the result as ``batch_id=<n>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_even(step(batch), f"{path}/batch_id={batch_id}")

    return write


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str], url: str) -> str:
    """The one statement that moves staged rows into the table, new rows winning."""
    names = ", ".join(columns)
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        return f"REPLACE INTO {table} ({names}) SELECT {names} FROM {staging}"
    match = " AND ".join(f"t.{key} = s.{key}" for key in keys)
    rest = [name for name in columns if name not in keys]
    update = f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)}" if rest else ""
    fresh = ", ".join(f"s.{name}" for name in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {match}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({fresh})"
    )


def jdbc_upsert(
    url: str, table: str, keys: Sequence[str], properties: dict[str, str],
    columns: Sequence[str] | None = None, connections: int = 3,
) -> BatchWriter:
    """Keyed upsert into a database: tasks fill a staging table, one statement merges it.

    ``columns`` are the table's names for the batch's columns, in order. At most
    ``connections`` tasks write at once. An error fails the batch, which the stream then
    repeats; both steps give the same result when repeated.
    """
    staging = f"{table}_staging"

    def write(batch: DataFrame, batch_id: int) -> None:
        options = properties | {"url": url, "dbtable": staging, "numPartitions": str(connections)}
        rows = batch.toDF(*columns) if columns else batch
        rows.write.format("jdbc").options(**options).mode("overwrite").save()
        jvm = batch.sparkSession.sparkContext._jvm
        login = jvm.java.util.Properties()
        for key, value in properties.items():
            login.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(url, login)
        try:
            statement = connection.createStatement()
            statement.executeUpdate(upsert_statement(table, staging, rows.columns, keys, url))
        finally:
            connection.close()

    return write


def console(
    rows: DataFrame, checkpoint: str, mode: str = "update", every: str = "10 seconds",
    show: int = 10,
) -> StreamingQuery:
    """Print the first rows of each batch."""
    writer = rows.writeStream.format("console").outputMode(mode).option("numRows", show)
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
