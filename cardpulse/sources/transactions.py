"""Transaction sources, the framed wire format and its decoding, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardpulse.schema import RAW_TOPIC, TX_SCHEMA

_PAYLOAD_FIELDS = [f for f in TX_SCHEMA.fields if f.name != "_schema_id"]


def kafka_options(brokers: str, topic: str = RAW_TOPIC, **overrides: str) -> dict[str, str]:
    """Options of the transaction topic: committed records only, from the latest offset on."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "kafka.isolation.level": "read_committed",
        "failOnDataLoss": "false",
        **overrides,
    }


def read_transactions(
    spark: SparkSession,
    source: str,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """A1: open a transaction source.

    ``source="kafka"`` takes the options of :func:`kafka_options` and needs the Kafka package on the classpath.
    Any file format needs ``path`` and, when streaming, a ``schema``. Both forms give a DataFrame to which every
    operator applies.
    """
    reader = (spark.readStream if streaming else spark.read).format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def split_wire_frame(df: DataFrame, value: str = "value") -> DataFrame:
    """A2: add ``schema_id``, ``payload`` and ``frame_error`` (null for a good frame).

    A frame is one zero byte, a four-byte big-endian schema id, then the payload.
    """
    frame = F.col(value)
    error = (
        F.when(frame.isNull(), "missing")
        .when(F.octet_length(frame) < 5, "too short")
        .when(F.substring(frame, 1, 1) != F.lit(b"\x00"), "bad magic byte")
    )
    schema_id = F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("bigint")
    return (
        df.withColumn("frame_error", error)
        .withColumn("schema_id", F.when(F.col("frame_error").isNull(), schema_id))
        .withColumn("payload", F.when(F.col("frame_error").isNull(), F.expr(f"substring(`{value}`, 6)")))
    )


def _record_fields(record: str, writer: T.StructType) -> Column:
    """The record projected on the target layout; fields the writer did not know are null. A logical timestamp becomes
    the epoch milliseconds that the layout has (a cast to a number would give seconds).
    """
    kinds = {f.name: f.dataType for f in writer.fields}

    def value(field: T.StructField) -> Column:
        if field.name not in kinds:
            return F.lit(None)
        column = F.col(f"{record}.{field.name}")
        if isinstance(kinds[field.name], (T.TimestampType, T.TimestampNTZType)) and isinstance(
                field.dataType, T.LongType):
            return F.unix_millis(column.cast("timestamp"))
        return column

    return F.struct(*[value(f).cast(f.dataType).alias(f.name) for f in _PAYLOAD_FIELDS])


def _parse(payload: Column, schema, fmt: str) -> Column:
    if fmt == "json":
        return F.from_json(payload.cast("string"), schema, {"mode": "PERMISSIVE"})
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package on the classpath

        return from_avro(payload, schema, {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format {fmt!r}")


def decode_transactions(df: DataFrame, schemas: dict, fmt: str = "json") -> DataFrame:
    """A3: decode ``payload`` with the writer's schema and lay the fields out as the target columns.

    ``schemas`` maps a schema id to its writer schema: a ``StructType`` for JSON payloads, an Avro schema text for
    Avro. A bad frame, an unknown id or a body that cannot be read leaves the fields null and says why in
    ``decode_error``; columns other than frame and payload are kept in front.
    """
    kept = [c for c in df.columns if c not in ("schema_id", "payload", "frame_error")]
    parsed = df
    record = None
    for schema_id, schema in schemas.items():
        name = f"_record_{schema_id}"
        mine = F.col("schema_id") == schema_id
        parsed = parsed.withColumn(name, F.when(mine, _parse(F.col("payload"), schema, fmt)))
        here = F.when(mine & F.col(name).isNotNull(), _record_fields(name, parsed.schema[name].dataType))
        record = here if record is None else F.coalesce(record, here)
    known = F.col("schema_id").isin([int(i) for i in schemas])
    return _laid_out(parsed.withColumn("_known", known).withColumn("_record", record), kept)


def _laid_out(parsed: DataFrame, kept: list[str]) -> DataFrame:
    """The fields of ``_record`` and the reason where there are none, from frame and ``_known`` (the schema id's)."""
    # The record leaves through a generator: a filter on its fields, such as the one on a missing id, stays above
    # it instead of being pushed down together with a second copy of the parsing.
    frame_error = F.col("frame_error") if "frame_error" in parsed.columns else F.lit(None).cast("string")
    fields = [f.name for f in _PAYLOAD_FIELDS]
    # A body without any field of the record counts as unreadable, as does one that is no record.
    anything = F.coalesce(*[F.col(f"_record.{f.name}").cast("string") for f in _PAYLOAD_FIELDS if f.name != "metadata"])
    opened = parsed.select(
        *kept, "schema_id", frame_error.alias("_frame_error"), "_known", "_record",
    ).select(
        *kept, "schema_id", "_frame_error", "_known", anything.isNotNull().alias("_read"),
        F.inline_outer(F.when(F.col("_record").isNotNull(), F.array("_record"))),
    )
    error = (
        F.when(F.col("_frame_error").isNotNull(), F.col("_frame_error"))
        .when(~F.col("_known"), "unknown schema id")
        .when(F.col("transaction_id").isNull() & F.col("_read"), "missing transaction_id")
        .when(F.col("transaction_id").isNull(), "unreadable body")
    )
    return opened.select(
        *kept, *fields, F.expr("try_cast(schema_id as int)").alias("_schema_id"), error.alias("decode_error"))


# Up to this many writer schemas, a row of about 200 bytes each, the registry goes to every task.
MOST_SENT = 10_000


def schema_registry(spark: SparkSession, schemas: dict[int, T.StructType]) -> DataFrame:
    """The JSON writers as a table (schema_id, fields, moments): the names that a writer knows, and those of them that
    are logical timestamps.
    """
    rows = [
        (int(i), [f.name for f in writer.fields],
         [f.name for f in writer.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))])
        for i, writer in schemas.items()
    ]
    registry = spark.createDataFrame(rows, "schema_id bigint, fields array<string>, moments array<string>")
    return F.broadcast(registry) if len(rows) <= MOST_SENT else registry


def decode_registered(df: DataFrame, registry: DataFrame) -> DataFrame:
    """A3 for JSON payloads of any number of writers: the result of :func:`decode_transactions`, with one parse in the
    plan however many schemas the ``registry`` (see :func:`schema_registry`) lists, one row per schema id.

    Bodies are parsed to a variant without a schema; a field counts if its writer lists it, and is read as the type
    the record has. A value of another JSON type is converted where it can be (``"12"`` to a number) and else null. A
    body that names a field twice is unreadable.
    """
    kept = [c for c in df.columns if c not in ("schema_id", "payload", "frame_error")]
    parsed = df.withColumn("_body", F.try_parse_json(F.col("payload").cast("string"))).join(
        registry.select("schema_id", F.col("fields").alias("_fields"), F.col("moments").alias("_moments")),
        "schema_id", "left")

    def value(field: T.StructField) -> Column:
        path, kind = f"$.{field.name}", field.dataType.simpleString()
        plain = F.try_variant_get("_body", path, kind)
        if isinstance(field.dataType, T.LongType):
            at = F.unix_millis(F.try_variant_get("_body", path, "timestamp"))
            plain = F.when(F.array_contains("_moments", field.name), at).otherwise(plain)
        return F.when(F.array_contains("_fields", field.name), plain).alias(field.name)

    record = F.when(F.col("_body").isNotNull() & F.col("_fields").isNotNull(), F.struct(*map(value, _PAYLOAD_FIELDS)))
    return _laid_out(
        parsed.withColumn("_known", F.col("_fields").isNotNull()).withColumn("_record", record), kept)


def publish_transactions(df: DataFrame, schema_id: int, fmt: str = "json", avro_schema: str | None = None) -> DataFrame:
    """One message per transaction: ``key`` is the user id, ``value`` the framed record."""
    fields = [f.name for f in _PAYLOAD_FIELDS if f.name in df.columns]
    record = F.struct(*fields)
    if fmt == "json":
        body = F.to_json(record).cast("binary")
    elif fmt == "avro":
        from pyspark.sql.avro.functions import to_avro  # needs the spark-avro package on the classpath

        body = to_avro(record, avro_schema) if avro_schema else to_avro(record)
    else:
        raise ValueError(f"unknown payload format {fmt!r}")
    header = b"\x00" + schema_id.to_bytes(4, "big")
    return df.select(
        F.col("user_id").cast("binary").alias("key"),
        F.concat(F.lit(header), body).alias("value"),
    )
