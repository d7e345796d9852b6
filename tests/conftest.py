from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from foyer.schemas import FIELD_SEPARATOR, TICKET_TOPIC  # noqa: E402
from foyer.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def ticket(**changes) -> dict:
    """A ticket with the golden values; a change to ``...`` leaves the field out."""
    fields = {
        # The golden results depend on them.
        "cinemaInnerCode": "139", "hallCode": "8", "movieCode": "051402342019",
        "movieShowStartTime": "2019-12-19 17:20:00",
        # Invented values.
        "ticketCode": "T-0001", "isRefund": "N", "showCode": "SHOW-A", "ticketPrice": 2500,
        "ticketPayInfo": [
            {"payCode": "card", "payValue": 3000, "webPayOrders": "order-1"},
            {"payCode": "cash", "payValue": 4000, "webPayOrders": "order-2"},
        ],
    } | changes
    return {name: value for name, value in fields.items() if value is not ...}


def line(*tickets: dict, topic: str = TICKET_TOPIC, sent: str = "2019-12-19 16:00:03") -> str:
    return FIELD_SEPARATOR.join([topic, json.dumps(list(tickets)), sent])


@pytest.fixture
def lines(spark):
    """Build a frame of feed lines."""
    return lambda *texts: spark.createDataFrame([(text,) for text in texts], "value string")


@pytest.fixture
def golden(lines):
    """The sale and its refund, a line each."""
    return lines(line(ticket()), line(ticket(isRefund="Y")))


def rows(frame) -> list[tuple]:
    return sorted(map(tuple, frame.collect()), key=repr)
