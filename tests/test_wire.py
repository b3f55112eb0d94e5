"""Frames, decoding, validation, publishing."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from cardpulse.operators import conform
from cardpulse.plans.adapter import many_writers, timestamp_schema, writer_schemas
from cardpulse.schema import TX_SCHEMA
from cardpulse.sources.transactions import (
    decode_registered,
    decode_transactions,
    kafka_options,
    publish_transactions,
    read_transactions,
    schema_registry,
    split_wire_frame,
)

SAMPLE = {
    "transaction_id": "order/7741", "user_id": "b8f2", "amount": 1250.5, "currency": "CHF",
    "merchant_id": "bakery", "merchant_country": "CH", "user_country": "AT", "device_id": None,
    "status": "DECLINED", "failure_reason": "INSUFFICIENT_FUNDS", "ip_address": "203.0.113.9",
    "event_time": 1712345678901, "metadata": {"channel": "till"},
}


def frame(body, schema_id=42, magic=b"\x00"):
    return magic + struct.pack(">I", schema_id) + (body if isinstance(body, bytes) else json.dumps(body).encode())


def messages(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value binary")


def test_split(spark):
    values = [frame(b"payload"), None, b"\x00\x00\x00\x00", frame(b""), frame(b"x", magic=b"\x01"),
              frame(b"y", 0xFFFFFFFF), b""]
    got = [(r.schema_id, r.payload and bytes(r.payload), r.frame_error)
           for r in split_wire_frame(messages(spark, values)).orderBy("n").collect()]
    assert got == [(42, bytearray(b"payload"), None), (None, None, "missing"), (None, None, "too short"),
                   (42, b"", None), (None, None, "bad magic byte"), (0xFFFFFFFF, b"y", None), (None, None, "too short")]


def test_decode_by_writer_schema(spark):
    older = {k: v for k, v in SAMPLE.items() if k not in ("currency", "metadata")}
    values = [frame(SAMPLE), frame({**older, "currency": "XXX"}, 7), frame(SAMPLE, 99), frame(b"{broken"), b"\x01",
              frame(SAMPLE, 0xFFFFFFFF)]
    rows = decode_transactions(split_wire_frame(messages(spark, values)), writer_schemas()).orderBy("n").collect()
    assert [r.decode_error for r in rows] == [
        None, None, "unknown schema id", "unreadable body", "too short", "unknown schema id"]
    assert rows[0].asDict(recursive=True) == {
        **SAMPLE, "n": 0, "value": bytearray(values[0]), "_schema_id": 42, "decode_error": None}
    assert (rows[1].currency, rows[1].metadata, rows[1].amount, rows[1]._schema_id) == (None, None, 1250.5, 7)
    assert rows[2].transaction_id is None and rows[3].transaction_id is None
    assert rows[5]._schema_id is None  # beyond a signed integer


def test_decoded_layout_is_the_target_schema(spark):
    df = decode_transactions(split_wire_frame(messages(spark, [])), writer_schemas()).drop("n", "value", "decode_error")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TX_SCHEMA]


def test_a_filter_does_not_repeat_the_decoding(spark):
    df = conform.keep_decoded(decode_transactions(split_wire_frame(messages(spark, [frame(SAMPLE)])), writer_schemas()))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == len(writer_schemas())


def test_conform(spark):
    bad = [{**SAMPLE, "user_id": None}, {**SAMPLE, "status": "REVERSED"}, {**SAMPLE, "status": None},
           {**SAMPLE, "event_time": None}]
    fine = {**SAMPLE, "currency": None, "metadata": None, "device_id": None}
    decoded = decode_transactions(split_wire_frame(messages(spark, [frame(x) for x in [*bad, fine]])), writer_schemas())
    good, rejected = conform.conform_transactions(decoded)
    assert [r.reject_reason for r in rejected.orderBy("n").collect()] == [
        "missing user_id", "unknown status", "missing status", "missing event_time"]
    kept = conform.with_event_time(good).select("*", F.unix_micros("event_time").alias("us")).collect()
    assert [(r.n, r.currency, r.metadata, r.us) for r in kept] == [(4, "EUR", {}, 1712345678901000)]


def test_publish_round_trip(spark):
    record = spark.createDataFrame([SAMPLE], TX_SCHEMA).drop("_schema_id")
    message = publish_transactions(record, 42)
    row = message.first()
    assert bytes(row.key) == b"b8f2"
    assert bytes(row.value[:5]) == b"\x00\x00\x00\x00\x2a"
    back = decode_transactions(split_wire_frame(message), writer_schemas()).first()
    assert {k: back[k] for k in SAMPLE} == SAMPLE


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "transaction_id string, n int")
    assert sorted(map(tuple, conform.dedupe_transactions(df).collect())) == [("a", 1), ("b", 2)]


def test_kafka_options():
    assert kafka_options("broker:9092", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "raw-transactions", "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed", "failOnDataLoss": "false"}


def test_file_sources(spark, tmp_path):
    path = str(tmp_path / "frames")
    messages(spark, [frame(SAMPLE)]).write.parquet(path)
    batch = read_transactions(spark, "parquet", path, streaming=False)
    stream = read_transactions(spark, "parquet", path, schema=batch.schema)
    assert (batch.isStreaming, stream.isStreaming) == (False, True)
    assert batch.schema == stream.schema


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        publish_transactions(spark.createDataFrame([SAMPLE], TX_SCHEMA), 1, "xml")
    with pytest.raises(ValueError):
        decode_transactions(split_wire_frame(messages(spark, [])), writer_schemas(), "xml")


def test_a_logical_timestamp_becomes_epoch_milliseconds(spark):
    from pyspark.sql import types as T

    for kind in (T.TimestampType(), T.TimestampNTZType()):
        writer = T.StructType([T.StructField(f.name, kind) if f.name == "event_time" else f
                               for f in writer_schemas()[42].fields])
        body = {**SAMPLE, "event_time": "2024-04-05T19:34:38.901"}
        row = decode_transactions(split_wire_frame(messages(spark, [frame(body)])), {42: writer}).first()
        assert (row.event_time, row.decode_error) == (SAMPLE["event_time"], None)


def test_a_body_that_only_misses_its_id_says_so(spark):
    nameless = {k: v for k, v in SAMPLE.items() if k != "transaction_id"}
    values = [frame(nameless), frame(b"[]"), frame(b"{}"), frame(b"")]
    rows = decode_transactions(split_wire_frame(messages(spark, values)), writer_schemas()).orderBy("n").collect()
    assert [r.decode_error for r in rows] == ["missing transaction_id"] + ["unreadable body"] * 3


def test_registered_writers_decode_alike(spark):
    older = {k: v for k, v in SAMPLE.items() if k not in ("currency", "metadata")}
    nameless = {k: v for k, v in SAMPLE.items() if k != "transaction_id"}
    values = [frame(SAMPLE), frame({**older, "currency": "XXX"}, 7), frame(SAMPLE, 99), frame(b"{broken"), b"\x01", None,
              frame(SAMPLE, 0xFFFFFFFF), frame(nameless), frame(b"[]"), frame(b"{}"), frame(b""), frame(b"null"),
              frame({**SAMPLE, "event_time": "2024-04-05T19:34:38.901Z"}, 8)]
    schemas = writer_schemas() | {8: timestamp_schema()}
    split = split_wire_frame(messages(spark, values))
    one = decode_registered(split, schema_registry(spark, schemas))
    each = decode_transactions(split, schemas)
    assert [(f.name, f.dataType) for f in one.schema] == [(f.name, f.dataType) for f in each.schema]
    assert one.orderBy("n").collect() == each.orderBy("n").collect()
    assert one.where("n = 12").first().event_time == SAMPLE["event_time"]


def test_registered_values_of_other_types(spark):
    bodies = [{**SAMPLE, "amount": "12.5"}, {**SAMPLE, "amount": "much"}, b'{"amount": 1, "amount": 2}']
    rows = decode_registered(
        split_wire_frame(messages(spark, [frame(b) for b in bodies])), schema_registry(spark, writer_schemas())
    ).orderBy("n").collect()
    assert [(r.amount, r.decode_error) for r in rows] == [(12.5, None), (None, None), (None, "unreadable body")]


def test_the_plan_does_not_grow_with_the_writers(spark):
    split = split_wire_frame(messages(spark, [frame(SAMPLE)]))

    def plan(schemas):
        df = conform.keep_decoded(decode_registered(split, schema_registry(spark, schemas)))
        return df._jdf.queryExecution().optimizedPlan().toString()

    few, many = plan(writer_schemas()), plan(many_writers())
    assert few.lower().count("parsejson") == many.lower().count("parsejson") <= 2  # the call and its argument's name
    assert few.count("\n") == many.count("\n") and abs(len(few) - len(many)) < 200


def test_a_stream_decodes_by_the_registry(spark, tmp_path):
    path = str(tmp_path / "frames")
    messages(spark, [frame(SAMPLE), frame(SAMPLE, 99)]).write.parquet(path)
    stream = read_transactions(spark, "parquet", path, schema="n int, value binary")
    decode_registered(split_wire_frame(stream), schema_registry(spark, writer_schemas())).writeStream.format(
        "parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(
        str(tmp_path / "rows")).awaitTermination()
    assert [(r.n, r.transaction_id) for r in spark.read.parquet(str(tmp_path / "rows")).orderBy("n").collect()] == [
        (0, "order/7741"), (1, None)]
