"""Feed lines to ticket rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.functions.pay import loose_pay_total, pay_total
from foyer.functions.showing import business_date, clock_part, showing_key
from foyer.functions.text import has_tag, json_field, line_field
from foyer.operators.rejects import REASON, reject_reason
from foyer.schemas import LOOSE_PAY_ITEMS, PAY_VALUES, SHOW_DETAILS, TICKET_TOPIC, ticket_record


def explode_tickets(lines: DataFrame, record: str, body_field: int = 1) -> DataFrame:
    """One row per ticket of each line's JSON array: ``line`` and ``ticket`` (a struct).

    ``record`` is the DDL of the fields the job needs; the parser skips all others. An
    empty array gives no row, an unreadable one gives a row whose ticket is NULL.
    """
    array = F.from_json(line_field(F.col("value"), body_field), f"array<{record}>")
    unreadable = F.array(F.lit(None).cast(record))
    return lines.select(
        F.col("value").alias("line"), F.explode(F.coalesce(array, unreadable)).alias("ticket")
    )


def explode_ticket_texts(lines: DataFrame, body: str = "data", strict: bool = False) -> DataFrame:
    """One row per array element, as JSON text, in ``order``.

    An unreadable array gives no row; ``strict`` makes it fail the job.
    """
    array = F.from_json(body, "array<string>")
    if strict:
        failure = F.raise_error(F.concat(F.lit("rejected row: unreadable array: "), F.col(body)))
        array = F.coalesce(array, failure.cast("array<string>"))
    return lines.select(F.explode(array).alias("order"))


def sale_tickets(lines: DataFrame, shows: bool = False) -> DataFrame:
    """Showing key and amount of every ticket, sale or refund alike, with ``reject_reason``.

    ``shows`` adds ``show_code``.
    """
    needed = ["cinemaInnerCode", "hallCode", "movieShowStartTime", "movieCode"]
    if shows:
        needed.append("showCode")
    exploded = explode_tickets(lines, ticket_record(*needed, ticketPayInfo=PAY_VALUES))
    cinema, hall, start, movie, items = (
        F.col(f"ticket.{name}") for name in (*needed[:4], "ticketPayInfo")
    )
    amount = pay_total(items)
    extra = [F.col("ticket.showCode").alias("show_code")] if shows else []
    return exploded.select(
        "line",
        *showing_key(cinema, hall, start, movie),
        *extra,
        amount.alias("amount"),
        reject_reason(
            unreadable_ticket=F.col("ticket").isNull(),
            missing_cinemaInnerCode=cinema.isNull(),
            missing_hallCode=hall.isNull(),
            short_movieShowStartTime=F.coalesce(F.length(start) < 16, F.lit(True)),
            short_movieCode=F.coalesce(F.length(movie) < 4, F.lit(True)),
            missing_ticketPayInfo=items.isNull(),
            unreadable_payValue=amount.isNull(),
        ),
    )


def presale_tickets(lines: DataFrame, since: str, topic: str = TICKET_TOPIC) -> DataFrame:
    """Signed counts and amounts of tickets for business days from ``since`` on.

    Only lines tagged ``topic`` count. A ticket marked ``N`` adds; any other mark, or
    none, takes away.
    """
    tagged = lines.where(has_tag(F.col("value"), topic))
    record = ticket_record(
        "cinemaInnerCode", "movieCode", "movieShowStartTime", "isRefund",
        ticketPayInfo=LOOSE_PAY_ITEMS,
    )
    ticket = F.col("ticket")
    start, items = ticket["movieShowStartTime"], ticket["ticketPayInfo"]
    day, total = business_date(start), loose_pay_total(items)
    sign = F.when(ticket["isRefund"].eqNullSafe("N"), 1).otherwise(-1).cast("bigint")
    signed = explode_tickets(tagged, record).select(
        "line",
        day.alias("date_id"),
        clock_part(start).alias("show_time"),
        F.coalesce(ticket["cinemaInnerCode"], F.lit("-")).alias("cinemaInnerCode"),
        F.coalesce(ticket["movieCode"], F.lit("-")).alias("movieCode"),
        sign.alias("ticket_num"),
        (sign * total).alias("ticket_amt"),
        reject_reason(
            unreadable_ticket=ticket.isNull(),
            unreadable_movieShowStartTime=day.isNull(),
            missing_ticketPayInfo=items.isNull(),
            unreadable_payValue=total.isNull(),
        ),
    )
    return signed.where(F.col("date_id").isNull() | (F.col("date_id") >= since))


def schedule_messages(lines: DataFrame, kind: str = SHOW_DETAILS) -> DataFrame:
    """The JSON bodies whose ``syncType`` is ``kind``, in ``message``, with ``line`` and ``reject_reason``.

    A body is rejected that is no JSON object or has no ``syncType``; other types are neither kept nor rejected.
    """
    body = line_field(F.col("value"), 1)
    head = F.from_json(body, "syncType string, unreadable string", {"columnNameOfCorruptRecord": "unreadable"})
    messages = lines.select(
        F.col("value").alias("line"), body.alias("message"), json_field(body, "syncType").alias("kind"), head.alias("head")
    ).select(
        "line", "message", "kind",
        reject_reason(
            missing_body=F.coalesce(F.trim("message") == "", F.lit(True)),
            unreadable_message=F.col("head").isNull() | F.col("head.unreadable").isNotNull(),
            missing_syncType=F.col("kind").isNull(),
        ),
    )
    return messages.where(F.col(REASON).isNotNull() | (F.col("kind") == kind)).drop("kind")
