"""Feeds in the shape the jobs read, derived row by row from the given tables.

Each line comes from one table row, so deriving a feed needs no shuffle and no row or
line grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from foyer.functions.text import line_field
from foyer.operators.tickets import explode_ticket_texts
from foyer.schemas import FIELD_SEPARATOR, SCHEDULE_TOPIC, SHOW_DETAILS, TICKET_TOPIC
from foyer.session import shared_folder
from foyer.sources.files import text_lines
from foyer.sources.streams import file_stream


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a batch."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream. The pattern matches a single file as well as a folder."""
    schema = table(spark, sf_dir, name).schema
    return file_stream(spark, schema).parquet(f"{sf_dir}/{name}.parque[t]")


def spread(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; if it scans in fewer tasks than there are cores, shared by all.

    Spark cuts any table above 4 MiB per core into a task for each, so this moves small
    tables only.
    """
    rows = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(
        spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
    )


def _text(expression: str) -> Column:
    return F.expr(f"cast({expression} as string)")


def _ticket(mark: Column) -> Column:
    cents = "cast(round(l_extendedprice * 100) as bigint)"
    first = f"({cents} * l_linenumber div 8)"

    def item(code: str, value: str) -> Column:
        return F.struct(
            F.lit(code).alias("payCode"), F.expr(value).alias("payValue"),
            F.lit("").alias("thirdPayOrderId"), F.lit(code.upper()).alias("webPayOrders"),
        )

    items = F.array(item("card", first), item("cash", f"{cents} - {first}"))
    no_items = F.slice(items, 1, 0)
    month = F.substring(F.col("l_shipdate").cast("string"), 1, 8)
    hour = F.lpad(_text("l_partkey % 4 * 6 + 5"), 2, "0")
    film = F.lpad(_text("l_partkey % 10"), 3, "0")
    return F.struct(
        _text("l_suppkey % 5").alias("cinemaInnerCode"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("ticketCode"),
        _text("l_orderkey").alias("sellOrderId"),
        mark.alias("isRefund"),
        F.concat(F.lit("C"), _text("l_suppkey % 5"), F.lit("X"), _text("l_partkey % 100")).alias("showCode"),
        F.concat(film, _text("l_suppkey % 3"), F.lit("02342019")).alias("movieCode"),
        _text("l_linenumber % 3").alias("hallCode"),
        F.concat(month, F.lit("01 "), hour, F.lit(":20:00")).alias("movieShowStartTime"),
        F.expr(cents).alias("ticketPrice"),
        F.when(F.col("l_discount") == 0, no_items).otherwise(items).alias("ticketPayInfo"),
    )


def _ticket_array() -> Column:
    # A sale; the mark is absent on the seventh line of an order. A returned line brings
    # its refund in the same array.
    sale = _ticket(F.when(F.col("l_linenumber") != 7, F.lit("N")))
    refund = _ticket(F.lit("Y"))
    both, one = F.array(sale, refund), F.array(sale)
    return F.to_json(F.when(F.col("l_returnflag") == "R", both).otherwise(one))


def _sent() -> Column:
    return F.concat(F.substring(F.col("l_shipdate").cast("string"), 1, 10), F.lit(" 16:00:03"))


def ticket_lines(lineitem: DataFrame) -> DataFrame:
    """Raw feed: tag, JSON array of tickets, send time. A sixth line has another tag."""
    tag = F.when(F.col("l_linenumber") == 6, SCHEDULE_TOPIC).otherwise(TICKET_TOPIC)
    lines = lineitem.select(F.concat_ws(FIELD_SEPARATOR, tag, _ticket_array(), _sent()).alias("value"))
    # A filter on a derived line would move below it and derive the line again, in code too long to be
    # compiled; a generator holds it back.
    return lines.select(F.explode(F.array("value")).alias("value"))


def landed_lines(lineitem: DataFrame) -> DataFrame:
    """Landed log: JSON array, padded send time, and ``dt``; first lines are sent twice."""
    line = F.concat_ws(FIELD_SEPARATOR, _ticket_array(), F.concat(_sent(), F.lit("  ")))
    copies = F.when(F.col("l_linenumber") == 1, 2).otherwise(1)
    lines = lineitem.select(
        line.alias("value"), copies.alias("copies"),
        F.concat(F.substring(_sent(), 1, 8), F.lit("01")).alias("dt"),
    )
    return lines.select(F.explode(F.array_repeat("value", F.col("copies"))).alias("value"), "dt")


def schedule_lines(events: DataFrame) -> DataFrame:
    """Schedule feed: tag and a JSON object; ``view`` events stand for show details."""
    kind = F.when(F.col("event_type") == "view", SHOW_DETAILS).otherwise(F.col("event_type"))
    body = F.to_json(F.struct(kind.alias("syncType"), F.col("event_id").alias("id"), F.col("props").alias("props")))
    return events.select(F.concat_ws(FIELD_SEPARATOR, F.lit(SCHEDULE_TOPIC), body).alias("value"))


def id_lines(events: DataFrame) -> DataFrame:
    """JSON messages of an id and a score; ``error`` events come without a score."""
    score = F.when(F.col("event_type") != "error", F.col("value").cast("int"))
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("id"), score.alias("score")))
    return events.select(body.alias("value"))


def event_lines(events: DataFrame) -> DataFrame:
    """Words of an event, parted by a space and a tab, with the event's time."""
    words = F.concat("event_type", F.lit(" "), "props", F.lit("\t "))
    return events.select(F.col("ts").alias("at"), words.alias("value"))


def comma_lines(documents: DataFrame) -> DataFrame:
    """Whole texts with two attributes, comma-separated, ending in empty fields."""
    parts = ("text", "lang", F.concat(F.lit(" "), F.col("source")), F.lit(""), F.lit(""))
    return documents.select(F.concat_ws(",", *parts).alias("value"))


def pipe_lines(part: DataFrame) -> DataFrame:
    """Part attributes, pipe-separated, with empty fields inside and at the end."""
    parts = ("p_brand", F.lit(""), "p_type", "p_name", F.lit(""), F.lit(""))
    return part.select(F.concat_ws("|", *parts).alias("value"))


_landed: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Names, sizes and times of a table's files: what changes when the table does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


def landed(spark: SparkSession, sf_dir: str, kind: str, name: str, write: Callable[[str], None]) -> str:
    """Folder of an input derived from the table ``name``, written once per state of its files.

    A table that has changed since gives a new copy. It is a written table on shared storage, so
    losing an executor loses nothing; the copies go when the application ends.
    """
    key = (spark.sparkContext.applicationId, kind, _state(spark, sf_dir, name))
    if key not in _landed:
        path = shared_folder(spark, kind)
        write(path)
        _landed[key] = path
    return _landed[key]


def _writer(lines: DataFrame) -> DataFrameWriter:
    # Packed text cannot be split for reading, so the files stay small.
    return lines.write.options(compression="lz4", maxRecordsPerFile=500_000)


def ticket_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ticket feed, derived from ``lineitem`` in the plan: nothing is written, nothing moves."""
    return ticket_lines(table(spark, sf_dir, "lineitem"))


def ticket_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The raw ticket feed as a stream over the files of ``lineitem``, derived as it is read."""
    columns = table(spark, sf_dir, "lineitem").schema
    rows = file_stream(spark, columns, files_per_batch).parquet(f"{sf_dir}/lineitem.parque[t]")
    return ticket_lines(rows)


def ticket_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw ticket feed as text files."""
    def write(path: str) -> None:
        _writer(ticket_lines(lineitem(spark, sf_dir))).text(path)

    return landed(spark, sf_dir, "ticket-feed", "lineitem", write)


def landed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed log's lines with their ``dt``, derived from ``lineitem`` in the plan: nothing is written."""
    return landed_lines(table(spark, sf_dir, "lineitem"))


def landed_files(spark: SparkSession, sf_dir: str) -> str:
    """The landed log below ``dt=`` folders; rebalancing evens out large and small dates."""
    def write(path: str) -> None:
        lines = landed_lines(lineitem(spark, sf_dir)).hint("rebalance", "dt")
        _writer(lines).partitionBy("dt").text(path)

    return landed(spark, sf_dir, "landed-log", "lineitem", write)


def json_files(spark: SparkSession, sf_dir: str) -> str:
    """The tickets of the feed as one JSON object per line."""
    def write(path: str) -> None:
        bodies = text_lines(spark, ticket_files(spark, sf_dir)).select(line_field(F.col("value"), 1).alias("data"))
        _writer(explode_ticket_texts(bodies, strict=True)).text(path)

    return landed(spark, sf_dir, "json-tickets", "lineitem", write)


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """Whole document texts as text files; a newline in a text starts a new line."""
    def write(path: str) -> None:
        _writer(spread(spark, sf_dir, "documents", "text")).text(path)

    return landed(spark, sf_dir, "documents", "documents", write)


def id_files(spark: SparkSession, sf_dir: str) -> str:
    """The id messages as text files."""
    def write(path: str) -> None:
        _writer(id_lines(spread(spark, sf_dir, "events", "event_type", "user_id", "value"))).text(path)

    return landed(spark, sf_dir, "id-messages", "events", write)


def comma_files(spark: SparkSession, sf_dir: str) -> str:
    """The comma-separated lines, each with a whole text, as parquet: texts hold newlines."""
    def write(path: str) -> None:
        comma_lines(spread(spark, sf_dir, "documents", "text", "lang", "source")).write.parquet(path)

    return landed(spark, sf_dir, "comma-lines", "documents", write)
