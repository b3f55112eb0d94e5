"""A running scorer: requests of a stream against the feature tables as they are when each micro-batch comes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.operators.store import online_user_features, read_online
from cardpulse.plans.scored import alert_messages, decide_requests
from cardpulse.schema import ALERT_THRESHOLD, TRANSACTION_FEATURES, USER_FEATURES

OpenTables = Callable[[SparkSession, str], tuple[DataFrame, DataFrame]]


def stored_features(users_path, tx_path) -> OpenTables:
    """Live rows of the wide user table and the transaction table; each may be a list, see ``read_online``."""
    return lambda spark, as_of: (
        read_online(spark, USER_FEATURES, users_path, as_of), read_online(spark, TRANSACTION_FEATURES, tx_path, as_of))


def online_features(user_paths: dict[str, str], tx_path) -> OpenTables:
    """Live rows of the five user features, joined into one row a user, and of the transaction table."""
    return lambda spark, as_of: (
        online_user_features(spark, user_paths, as_of), read_online(spark, TRANSACTION_FEATURES, tx_path, as_of))


def start_scorer(
    requests: DataFrame, open_tables: OpenTables, decisions_path: str, checkpoint: str, model=None,
    threshold: float = ALERT_THRESHOLD, time: str = "event_time", publish: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
):
    """Decide on requests (transaction_id, user_id, ``time``) as they come; returns the running query.

    A table that is joined to a stream keeps the files that it had when the query was planned. Here each micro-batch opens
    the tables anew, as of its newest request, so features written since the batch before count. Values expire by that
    time, not by the clock. Decisions are written whole to ``decisions_path/batch_id=N`` with ``scored_as_of``; a batch
    that is repeated replaces its own. ``publish`` gets the decisions' messages (topic, key, value), read back from what
    was written, so what is published is what is stored; it may get them again after a failure.

    Requests without a user, or of one without live features, are decided on what there is; an empty batch writes none.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            as_of = batch.agg(F.max(time).cast("string")).first()[0]
            if as_of is None:
                return
            live_users, live_tx = open_tables(spark, as_of)
            decided = decide_requests(batch.select("transaction_id", "user_id"), live_users, live_tx, model, threshold)
            path = f"{decisions_path.rstrip('/')}/batch_id={batch_id}"
            decided.withColumn("scored_as_of", F.lit(as_of).cast("timestamp")).write.mode("overwrite").parquet(path)
            if publish is not None:
                publish(alert_messages(spark.read.parquet(path)), batch_id)
        finally:
            batch.unpersist()

    writer = requests.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()
