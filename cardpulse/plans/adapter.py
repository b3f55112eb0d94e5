"""Card transactions, profiles and labels derived from the ``events`` and ``customer`` tables.

Time is compressed 360-fold (30 days become two hours) so that windows fill and thresholds fire. Amounts are also
given as whole cents, whose sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.sources.transactions import read_transactions

EPOCH_US = 1704067200000000
SPEEDUP = 360

# Columns of a transaction as SQL expressions over an event and its number k.
_TX = {
    "transaction_id": "'tx-' || event_id",
    "user_id": "'user-' || user_id",
    "amount_cents": "cast(round(value * 100) as bigint)",
    "amount": "cast(round(value * 100) as bigint) / 100.0D",
    "currency": "'EUR'",
    "merchant_id": "'merch-' || (k % 20)",
    "merchant_country": "element_at(array('FR', 'NG', 'RO', 'CN', 'US', 'DE'), 1 + k % 6)",
    "user_country": "'FR'",
    "device_id": "case when k % 10 <> 0 then 'device-' || (k % (1 + user_id % 7)) end",
    "status": "case event_type when 'error' then 'FAILED' when 'signup' then 'DECLINED' "
              "when 'view' then 'PENDING' else 'APPROVED' end",
    "failure_reason": "case when event_type in ('error', 'signup') then "
                      "element_at(array('INSUFFICIENT_FUNDS', 'CARD_BLOCKED', 'WRONG_PIN'), 1 + k % 3) end",
    "ip_address": "cast(null as string)",
    "event_us": f"{EPOCH_US} + (unix_micros(cast(ts as timestamp)) - {EPOCH_US}) div {SPEEDUP}",
    "metadata": "map('k', cast(k as string))",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_transactions(spark, "parquet", f"{sf_dir}/{name}.parquet", streaming=False)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written as a pattern because a stream takes a single file only that way.
    layout = table(spark, sf_dir, "events").schema
    return read_transactions(spark, "parquet", f"{sf_dir}/event[s].parquet", layout)


def _numbered(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.expr("cast(get_json_object(props, '$.k') as int)"))


def from_events(events: DataFrame) -> DataFrame:
    """Conformed transactions; a batch or a stream of events."""
    tx = _numbered(events).selectExpr("event_id", "k", *[f"{sql} as {name}" for name, sql in _TX.items()])
    return tx.withColumn("event_time", F.timestamp_micros("event_us"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(table(spark, sf_dir, "events"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in wire layout (epoch milliseconds), all valid."""
    return transactions(spark, sf_dir).withColumn("event_time", F.expr("event_us div 1000"))


def flawed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some miss a required field, have an unknown status, or leave defaults to be filled."""
    return flawed(records(spark, sf_dir))


def flawed(rows: DataFrame) -> DataFrame:
    return (
        rows
        .withColumn("merchant_id", F.expr("case when k <> 13 then merchant_id end"))
        .withColumn("status", F.expr("case when k = 29 then 'REVERSED' else status end"))
        .withColumn("amount", F.expr("case when k <> 41 then amount end"))
        .withColumn("user_id", F.expr("case when k <> 57 then user_id end"))
        .withColumn("currency", F.expr("case k % 4 when 0 then null when 1 then 'USD' else 'EUR' end"))
        .withColumn("metadata", F.expr("case when k % 5 <> 0 then metadata end"))
    )


# Writer schemas of the frames: the second one is older and lacks two fields.
CURRENT_SCHEMA_ID, OLDER_SCHEMA_ID = 42, 7


def writer_schemas() -> dict:
    from pyspark.sql.types import StructType

    from cardpulse.schema import TX_SCHEMA

    fields = [f for f in TX_SCHEMA.fields if f.name != "_schema_id"]
    return {
        CURRENT_SCHEMA_ID: StructType(fields),
        OLDER_SCHEMA_ID: StructType([f for f in fields if f.name not in ("currency", "metadata")]),
    }


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed messages (event_id, value), some of them broken."""
    return frames_of(records(spark, sf_dir))


def frames_of(rows: DataFrame) -> DataFrame:
    wire = [f.name for f in writer_schemas()[CURRENT_SCHEMA_ID].fields]
    body = F.to_json(F.struct(*wire)).cast("binary")
    older = F.to_json(F.struct(*[c for c in wire if c not in ("currency", "metadata")])).cast("binary")
    k = F.col("k")
    head = {i: F.lit(b"\x00" + i.to_bytes(4, "big")) for i in (CURRENT_SCHEMA_ID, OLDER_SCHEMA_ID, 99)}
    value = (
        F.when(k == 3, F.lit(None).cast("binary"))
        .when(k == 5, F.lit(b"\x00\x00\x00\x00"))
        .when(k == 7, F.concat(F.lit(b"\x01\x00\x00\x00\x2a"), body))
        .when(k == 11, F.concat(head[99], body))
        .when(k == 17, F.concat(head[CURRENT_SCHEMA_ID], F.lit(b"not a record")))
        .when(k % 2 == 0, F.concat(head[OLDER_SCHEMA_ID], older))
        .otherwise(F.concat(head[CURRENT_SCHEMA_ID], body))
    )
    return rows.select("event_id", value.alias("value"))


def timestamp_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed messages of a writer whose event time is a logical timestamp."""
    rows = transactions(spark, sf_dir)
    body = F.to_json(F.struct(*[f.name for f in timestamp_schema().fields])).cast("binary")
    return rows.select("event_id", F.concat(F.lit(b"\x00" + CURRENT_SCHEMA_ID.to_bytes(4, "big")), body).alias("value"))


def timestamp_schema():
    from pyspark.sql.types import StructField, StructType, TimestampType

    return StructType([
        StructField(f.name, TimestampType()) if f.name == "event_time" else f
        for f in writer_schemas()[CURRENT_SCHEMA_ID].fields])


WRITERS = 200


def many_writers() -> dict:
    """Writer schemas 1000 to 1199: every second one lacks the currency, every third the metadata, and every fifth has a
    logical timestamp.
    """
    from pyspark.sql.types import StructType

    return {
        1000 + w: StructType([
            f for f in (timestamp_schema() if w % 5 == 0 else writer_schemas()[CURRENT_SCHEMA_ID]).fields
            if not (f.name == "currency" and w % 2) and not (f.name == "metadata" and w % 3 == 0)])
        for w in range(WRITERS)
    }


def frames_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed messages whose bodies hold every field, whatever their writer's schema lists."""
    rows = transactions(spark, sf_dir).withColumn("_writer", F.expr(f"event_id % {WRITERS}"))
    names = [f.name for f in writer_schemas()[CURRENT_SCHEMA_ID].fields]
    millis = F.struct(*[F.expr("event_us div 1000").alias(n) if n == "event_time" else F.col(n) for n in names])
    body = F.when(F.col("_writer") % 5 == 0, F.to_json(F.struct(*names))).otherwise(F.to_json(millis))
    head = F.concat(F.lit(b"\x00"), F.unhex(F.lpad(F.hex(F.col("_writer") + 1000), 8, "0")))
    return rows.select("event_id", F.concat(head, body.cast("binary")).alias("value"))


def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer; the country of those in debt is not known."""
    return table(spark, sf_dir, "customer").selectExpr(
        "'user-' || c_custkey as user_id",
        "case when c_acctbal >= 0 then element_at(array('FR', 'US', 'GB', 'DE', 'NG'), 1 + c_nationkey % 5) end as country",
    )


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).selectExpr(
        "transaction_id", "user_id", "cast(k % 13 = 0 as smallint) as label",
        "cast(null as string) as fraud_type", "event_time as event_timestamp",
    )
