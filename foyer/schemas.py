"""Fixed values of the feed: separators, tags and the ticket record."""

from __future__ import annotations

# What a raw feed line looks like.
FIELD_SEPARATOR = "\u0001"
TICKET_TOPIC = "pos_uturn_ticket_order"
SCHEDULE_TOPIC = "pos_transfer_sync"
SHOW_DETAILS = "Show_Details"

# The pay item and the 46 fields of a ticket order, in record order.
PAY_ITEMS = "array<struct<payCode:string,payValue:bigint,cardNums:string>>"
TICKET_FIELDS = {
    "cinemaInnerCode": "string",
    "ticketCode": "string",
    "sellOrderId": "string",
    "webOrderId": "string",
    "refundTicketCode": "string",
    "refundOrderId": "string",
    "isRefund": "string",
    "showCode": "string",
    "isThroughShow": "string",
    "movieCode": "string",
    "oldMovieCode": "string",
    "movieName": "string",
    "hallCode": "string",
    "hallName": "string",
    "hallTypeCode": "string",
    "seatRow": "string",
    "seatColumn": "string",
    "regionId": "string",
    "regionName": "string",
    "movieShowStartTime": "string",
    "movieShowEndTime": "string",
    "ticketTypeCode": "string",
    "ticketTypeName": "string",
    "campaignCode": "string",
    "campaignName": "string",
    "memberId": "string",
    "dealTime": "string",
    "userId": "string",
    "userName": "string",
    "channelCode": "string",
    "channelName": "string",
    "panYing": "bigint",
    "ticketPrice": "bigint",
    "moviePrice": "bigint",
    "ticketPayInfo": PAY_ITEMS,
    "serviceChargeValue": "bigint",
    "serviceChargePayInfo": PAY_ITEMS,
    "ticketFee": "bigint",
    "ticketFeePayInfo": PAY_ITEMS,
    "isFill": "string",
    "isReturnServiceCharge": "string",
    "isShowEndReturn": "string",
    "refundTicketFee": "bigint",
    "refundTicketFeePayInfo": PAY_ITEMS,
    "refundTicketFeePayCode": "string",
    "movieShowFeatureType": "string",
}

# Pay items whose value may come quoted: read as text, cast by the job.
LOOSE_PAY_ITEMS = "array<struct<payCode:string,payValue:string>>"
# Pay items reduced to what a job reads.
PAY_CODES = "array<struct<payCode:string,payValue:bigint>>"
PAY_VALUES = "array<struct<payValue:bigint>>"


def ticket_record(*fields: str, **types: str) -> str:
    """DDL of the ticket struct narrowed to ``fields``; ``types`` overrides a field's type."""
    named = {name: TICKET_FIELDS[name] for name in fields} | types
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in named.items()) + ">"


def ticket_table() -> str:
    """DDL of all 46 columns, for a JSON-lines scan."""
    return ", ".join(f"{name} {kind}" for name, kind in TICKET_FIELDS.items())
