from __future__ import annotations

import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import rows, ticket

from foyer.operators.sales import count_by_cinema
from foyer.schemas import TICKET_FIELDS
from foyer.session import shared_folder
from foyer.sources import files, streams, tables


def plan(frame) -> str:
    return frame._jdf.queryExecution().toString()


def test_landed_log_prunes_dates_and_trims(spark, tmp_path):
    for date in ("2019-12-18", "2019-12-19"):
        folder = tmp_path / f"dt={date}"
        folder.mkdir()
        (folder / "part").write_text(f"[]\u0001 {date} 16:00:03 \n")
    assert files.landed_log(spark, str(tmp_path)).count() == 2
    one = files.landed_log(spark, str(tmp_path), ["2019-12-19"])
    assert rows(one) == [("[]", "2019-12-19 16:00:03", "2019-12-19")]
    assert "PartitionFilters: [isnotnull(dt" in plan(one)


def test_json_tickets_have_46_columns_and_prune(spark, tmp_path):
    path = tmp_path / "orders.json"
    path.write_text("\n".join(json.dumps(ticket(cinemaInnerCode=c, extra=1)) for c in "112"))
    orders = files.json_tickets(spark, str(path))
    assert orders.columns == list(TICKET_FIELDS) and len(orders.columns) == 46
    kinds = [kind for _, kind in orders.dtypes]
    assert (kinds.count("string"), kinds.count("bigint"), len([k for k in kinds if k.startswith("array")])) == (36, 6, 4)
    assert orders.select("ticketPayInfo.cardNums", "panYing").first() == ([None, None], None)
    counts = count_by_cinema(orders)
    assert rows(counts) == [("1", 2), ("2", 1)]
    assert "ReadSchema: struct<cinemaInnerCode:string>" in plan(counts)


def test_write_text_replaces(spark, tmp_path):
    for texts in (["a", "b"], ["c"]):
        files.write_text(spark.createDataFrame([(t,) for t in texts], "value string"), str(tmp_path / "out"))
    assert rows(files.text_lines(spark, str(tmp_path / "out"))) == [("c",)]


def test_attached_table_pushes_the_filter(spark, sf_dir):
    customers = tables.attach_table(spark, "foyer_test_customer", f"{sf_dir}/customer.parquet")
    found = tables.point_filter(customers, "c_custkey", 7)
    assert found.count() == 1
    assert "EqualTo(c_custkey,7)" in plan(found)


def test_jdbc_options():
    slices = tables.Slices("date_id", "2019-01-01", "2020-01-01", 16)
    options = tables.jdbc_options("jdbc:mysql://host/db", "sales", {"user": "u"}, slices)
    assert options == {
        "url": "jdbc:mysql://host/db", "dbtable": "sales", "user": "u", "fetchsize": "10000",
        "partitionColumn": "date_id", "lowerBound": "2019-01-01", "upperBound": "2020-01-01", "numPartitions": "16",
    }


def test_kafka_options_from_properties():
    text = """
    # brokers
    kafka.broker.bootstrap.servers=h1:9092,h2:9092
    kafka.broker.zookeeper.connect=h1:2181
    kafka.newConsumer.group.id=g
    kafka.newConsumer.auto.offset.reset=latest
    kafka.newConsumer.enable.auto.commit=false
    kafka.newConsumer.key.deserializer=x
    kafka.newConsumer.max.poll.records=10
    """
    options = streams.kafka_options(streams.parse_properties(text.splitlines()), ["a", "b"], per_batch=500)
    assert options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "a,b", "startingOffsets": "latest",
        "kafka.max.poll.records": "10", "maxOffsetsPerTrigger": "500",
    }


def test_properties_as_such_files_have_them():
    text = r"""
    # a comment
    ! another
    plain=1
    spaced : two words\t
      tab	3
    empty
    url = http\://h:1/a=b
    list = a,\
        b,\
        c
    uni\u0020code = \u00e9
    slash = ends\\
    after = 5
    """
    assert streams.parse_properties(["last = on\\"]) == {"last": "on"}
    assert streams.parse_properties(text.splitlines()) == {
        "plain": "1", "spaced": "two words\t", "tab": "3", "empty": "", "url": "http://h:1/a=b", "list": "a,b,c",
        "uni code": "é", "slash": "ends\\", "after": "5",
    }


def session(checkpoint_dir: str | None, master: str = "yarn", app: str = "app-1"):
    """As much of a session as the folder needs."""
    conf = {"spark.checkpoint.dir": checkpoint_dir} if checkpoint_dir else {}
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_shared_folder_is_new_each_time_and_below_the_setting():
    one, two = (shared_folder(session("hdfs://nn/checkpoints/"), "x") for _ in range(2))
    assert one != two and one.startswith("hdfs://nn/checkpoints/foyer/x-")


def test_shared_folder_without_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(None), "x")
    local = [Path(shared_folder(session(None, "local[2]"), "x")).parents[1] for _ in range(2)]
    assert local[0] == local[1] and local[0].is_dir()
