"""Start the feature queries. Operators are those of the batch; only the sinks and output modes live here."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from cardpulse.functions.times import micros
from cardpulse.operators import features
from cardpulse.operators.conform import (
    conform_transactions,
    dedupe_transactions,
    keep_decoded,
    with_event_time,
    with_watermark,
)
from cardpulse.operators.store import push_features, write_online
from cardpulse.plans.tables import build_transaction_features
from cardpulse.schema import (
    ONLINE_VIEWS,
    TRANSACTION_FEATURES,
    TUMBLING_WATERMARK,
    WATERMARK,
    FeatureView,
)
from cardpulse.sources.transactions import decode_transactions, split_wire_frame


@dataclass(frozen=True)
class FeatureQuery:
    view: FeatureView
    compute: Callable[..., DataFrame]
    mode: str
    slide: str | None = None
    needs_profiles: bool = False

    def run(self, tx: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
        if self.needs_profiles:
            return self.compute(tx, profiles)
        return self.compute(tx, slide=self.slide)


# One query per feature: windows update as events arrive, row-wise features are final at once.
FEATURE_QUERIES = {
    "f01": FeatureQuery(ONLINE_VIEWS["tx_5min"], features.tx_counts, "update", "1 minute"),
    "f02": FeatureQuery(ONLINE_VIEWS["avg_amount_24h"], features.amount_stats, "update", "1 hour"),
    "f03": FeatureQuery(ONLINE_VIEWS["country_mismatch"], features.country_mismatch, "append", needs_profiles=True),
    "f04": FeatureQuery(ONLINE_VIEWS["velocity"], features.velocity, "update", "1 minute"),
    "f05": FeatureQuery(ONLINE_VIEWS["device_change"], features.device_change, "update", "1 hour"),
    "f06": FeatureQuery(ONLINE_VIEWS["failed_attempts"], features.failed_attempts, "update", "5 minutes"),
}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the first of these that is set: ``spark.checkpoint.dir``, the session's default place of
    streaming checkpoints, the warehouse. All nodes of a cluster share them.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.conf.get("spark.sql.streaming.checkpointLocation", None)
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    )
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def start_ingest(
    frames: DataFrame, schemas: dict, good_path: str, reject_path: str, checkpoint: str, fmt: str = "json",
    trigger: dict | None = None,
):
    """Framed messages into two tables, ``<path>/batch_id=N``: valid transactions with their event time, and all other
    messages with the reason (of the frame, the decoding or the validation). The source is read once; a batch that is
    repeated replaces itself.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_transactions(split_wire_frame(batch), schemas, fmt).persist()
        try:
            good, rejected = conform_transactions(keep_decoded(decoded))
            unread = decoded.where(F.col("transaction_id").isNull()).withColumn("reject_reason", F.col("decode_error"))
            with_event_time(good).drop("value", "decode_error").write.mode("overwrite").parquet(
                f"{good_path.rstrip('/')}/batch_id={batch_id}")
            rejected.unionByName(unread).drop("decode_error").write.mode("overwrite").parquet(
                f"{reject_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    return _writer(frames, "append", checkpoint, trigger).foreachBatch(write).start()


def ingest(frames: DataFrame, schemas: dict, fmt: str = "json", delay: str = WATERMARK) -> DataFrame:
    """Framed messages to valid transactions with event time and watermark, without the others: run
    :func:`start_ingest` on the same source to keep those, or read its table of valid transactions instead.
    """
    good, _ = conform_transactions(keep_decoded(decode_transactions(split_wire_frame(frames), schemas, fmt)))
    return with_watermark(with_event_time(good), delay)


def ingest_once(frames: DataFrame, schemas: dict, fmt: str = "json", delay: str = WATERMARK) -> DataFrame:
    """Like :func:`ingest`, and a transaction delivered again within the watermark counts once."""
    return dedupe_transactions(ingest(frames, schemas, fmt, delay))


def start_history_dedup(tx: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """I10 beyond the watermark: each ``transaction_id`` once, however late it is delivered again.

    New rows go to ``path/batch_id=N/event_date=D``. A batch leaves out ids that earlier batches hold on the same date (a
    row that is delivered again has its event time again), and reads only ids of its own dates: two bounds, the least and
    the greatest, prune the history. A batch that is repeated does not see its own rows or later ones and replaces itself.
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(["transaction_id"]).withColumn("event_date", F.to_date("event_time")).persist()
        try:
            low, high = fresh.agg(F.min("event_date"), F.max("event_date")).first()
            if batch_id and low is not None:
                known = spark.read.schema("transaction_id string, event_date date, batch_id bigint").parquet(root).where(
                    (F.col("batch_id") < batch_id) & F.col("event_date").between(F.lit(low), F.lit(high)))
                fresh_rows = fresh.join(known, ["transaction_id", "event_date"], "left_anti")
            else:
                fresh_rows = fresh
            fresh_rows.write.mode("overwrite").partitionBy("event_date").parquet(f"{root}/batch_id={batch_id}")
        finally:
            fresh.unpersist()

    return _writer(tx, "append", checkpoint, trigger).foreachBatch(write).start()


def start_late_split(
    tx: DataFrame, on_time_path: str, late_path: str, seen_path: str, checkpoint: str, delay: str = WATERMARK,
    trigger: dict | None = None,
):
    """I1 with a trace: rows later than the watermark go to a table of their own with ``lateness_us``, all others to the
    first; together they are all rows.

    The watermark of a batch is the greatest event time of the batches before it, less ``delay``. It travels as one row a
    batch in ``seen_path``, each holding the greatest time so far, so a batch reads the one before it, and a batch that is
    repeated finds the same watermark and replaces its rows.
    """
    good, late, seen = (p.rstrip("/") for p in (on_time_path, late_path, seen_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = None
            if batch_id:
                before = spark.read.schema("greatest bigint").parquet(f"{seen}/batch_id={batch_id - 1}").first()[0]
            bound = F.lit(before).cast("bigint") - micros(delay)
            at = F.unix_micros("event_time")
            is_late = F.coalesce(at < bound, F.lit(False))
            batch.where(~is_late).write.mode("overwrite").parquet(f"{good}/batch_id={batch_id}")
            batch.where(is_late).withColumn("lateness_us", bound - at).write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")
            batch.agg(F.greatest(F.max(at), F.lit(before).cast("bigint")).alias("greatest")).write.mode("overwrite").parquet(
                f"{seen}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return _writer(tx, "append", checkpoint, trigger).foreachBatch(write).start()


def _writer(df: DataFrame, mode: str, checkpoint: str, trigger: dict | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


# Rows of a micro-batch for one task of an aggregation over window copies.
ROWS_PER_TASK = 100_000


def partitions_for(rows: int, spark: SparkSession) -> int:
    """Tasks for micro-batches of up to ``rows`` rows; no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def start_feature(
    name: str,
    tx: DataFrame,
    online_path: str,
    checkpoint_root: str,
    profiles: DataFrame | None = None,
    trigger: dict | None = None,
    written_at=None,
    files: int | None = None,
    partitions: int | None = None,
):
    """Run one feature of :data:`FEATURE_QUERIES` into its online table; returns the running query.

    Each query has its own checkpoint below ``checkpoint_root``. Batches are written by the executors, in ``files``
    files each if given. ``partitions`` is the number of tasks that aggregate a batch and keep the state (the session's
    shuffle partitions unless given); a checkpoint holds on to the number it was made with.
    """
    query = FEATURE_QUERIES[name]
    spark, setting = tx.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_online(batch, query.view, online_path, batch_id, written_at, query.slide, files)

    spark.conf.set(setting, partitions or before)  # a query takes the session's settings as they are at its start
    try:
        writer = _writer(query.run(tx, profiles), query.mode, f"{checkpoint_root.rstrip('/')}/{name}", trigger)
        return writer.foreachBatch(write).start()
    finally:
        spark.conf.set(setting, before)


def start_push(
    result: DataFrame,
    view: FeatureView,
    online_path: str,
    offline_path: str,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    written_at=None,
    files: int | None = None,
    commits: str | None = None,
):
    """Push a stream of feature rows (with ``event_timestamp``) to online and offline table, with ``commits`` as one."""

    def write(batch: DataFrame, batch_id: int) -> None:
        push_features(batch, view, online_path, offline_path, batch_id, written_at, files=files, commits=commits)

    return _writer(result, mode, checkpoint, trigger).foreachBatch(write).start()


def start_transaction_push(tx, profiles, online_path, offline_path, checkpoint, trigger=None, written_at=None):
    """F03 pushed under the stored table's names."""
    rows = build_transaction_features(features.country_mismatch(tx, profiles))
    return start_push(rows, TRANSACTION_FEATURES, online_path, offline_path, checkpoint, "append", trigger, written_at)


def start_tumbling_velocity(tx: DataFrame, checkpoint: str, sink: str = "console", trigger: dict | None = None, **options):
    """F07 to a debugging sink; ``tx`` carries :data:`TUMBLING_WATERMARK`, see :func:`tumbling_input`."""
    return _writer(features.tumbling_velocity(tx), "append", checkpoint, trigger).format(sink).options(**options).start()


def tumbling_input(tx: DataFrame) -> DataFrame:
    return with_watermark(tx, TUMBLING_WATERMARK)


def start_messages(messages: DataFrame, checkpoint: str, sink: str = "kafka", trigger: dict | None = None, **options):
    """Write (topic, key, value) rows; the Kafka sink takes the topic from the column."""
    return _writer(messages, "append", checkpoint, trigger).format(sink).options(**options).start()
