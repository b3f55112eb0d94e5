"""The named queries, each a function of (spark, sf_dir). Timestamps leave as microsecond longs."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.operators import bucketed, conform, features, quality, risk_model, scoring, store
from cardpulse.plans import adapter, scored, tables
from cardpulse.plans.adapter import transactions
from cardpulse.schema import ONLINE_VIEWS, SCORING_USER_FEATURES, TRANSACTION_FEATURES, USER_FEATURES
from cardpulse.sources.tables import labels_between, user_profiles
from cardpulse.sources.transactions import (
    decode_registered,
    decode_transactions,
    publish_transactions,
    schema_registry,
    split_wire_frame,
)
from cardpulse.streaming import panes, scorer
from cardpulse.streaming import queries as streams

AS_OF = "2024-01-01 02:00:00"
LABELS_FROM, LABELS_TO = "2024-01-01 00:30:00", "2024-01-01 01:00:00"


def in_micros(df: DataFrame) -> DataFrame:
    """Timestamp columns as microsecond longs under the same names."""
    return df.select(*[
        F.unix_micros(f.name).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ])


def _cents(stats: DataFrame) -> DataFrame:
    """Amount statistics of cents in units. The deviation is rounded; the others are exact quotients."""
    return (
        stats.withColumn("avg_amount", F.col("avg_amount") / 100)
        .withColumn("stddev_amount", F.round(F.col("stddev_amount") / 100, 4))
        .withColumn("max_amount", F.col("max_amount") / 100)
        .withColumn("min_amount", F.col("min_amount") / 100)
        .withColumn("sum_amount", F.col("sum_amount") / 100)
    )


def _amounts(tx: DataFrame, window: str = "24 hours", slide: str = "1 hour") -> DataFrame:
    return _cents(features.amount_stats(tx, window, slide, amount="amount_cents"))


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_profiles(adapter.profile_table(spark, sf_dir))


def _user_features(spark: SparkSession, sf_dir: str, current_only: bool = False) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return tables.backfill_user_features(tx, _amounts(tx), features.device_change(tx), current_only)


def _stored(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``df``, computed once and read from ``path`` from then on."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _tx_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.build_transaction_features(
        features.country_mismatch(transactions(spark, sf_dir), _profiles(spark, sf_dir)))


def _live(df: DataFrame, view, slide: str | None = None, known_at: str = "event_timestamp") -> DataFrame:
    """Values as if each had been written when it became known, and looked up at AS_OF."""
    rows = store.online_rows(df, view, F.col(known_at), slide)
    return rows.where(F.lit(AS_OF).cast("timestamp") < F.col("expires_at"))


def tx_conformed(spark, sf_dir):
    good, _ = conform.conform_transactions(adapter.flawed_records(spark, sf_dir))
    return in_micros(conform.with_event_time(good).select(
        "transaction_id", "user_id", "amount", "currency", "merchant_id", "merchant_country", "user_country",
        "device_id", "status", "failure_reason", "event_time",
        F.size("metadata").cast("bigint").alias("metadata_size"), F.col("metadata")["k"].alias("metadata_k")))


def tx_rejected(spark, sf_dir):
    _, rejected = conform.conform_transactions(adapter.flawed_records(spark, sf_dir))
    return rejected.select("transaction_id", "reject_reason")


def wire_frame_split(spark, sf_dir):
    split = split_wire_frame(adapter.frames(spark, sf_dir))
    return split.select(
        "event_id", "frame_error", "schema_id",
        F.get_json_object(F.col("payload").cast("string"), "$.transaction_id").alias("payload_id"))


def tx_decoded(spark, sf_dir):
    decoded = decode_transactions(split_wire_frame(adapter.frames(spark, sf_dir)), adapter.writer_schemas())
    return decoded.select(
        "event_id", "decode_error", F.col("_schema_id").cast("bigint").alias("schema_id"), "transaction_id",
        "user_id", "amount", "currency", "device_id", "status", "event_time",
        F.col("metadata")["k"].alias("metadata_k"))


def tx_publish_roundtrip(spark, sf_dir):
    messages = publish_transactions(adapter.records(spark, sf_dir), adapter.CURRENT_SCHEMA_ID)
    back = conform.keep_decoded(decode_transactions(split_wire_frame(messages), adapter.writer_schemas()))
    return back.select(
        F.col("key").cast("string").alias("key"), "transaction_id", "user_id", "amount", "currency", "merchant_id",
        "merchant_country", "user_country", "device_id", "status", "failure_reason", "event_time",
        F.col("metadata")["k"].alias("metadata_k"))


def tx_dedup(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return conform.dedupe_transactions(tx.union(tx)).select(
        "transaction_id", "user_id", "amount_cents", "status", "event_us")


def f01_tx_counts(spark, sf_dir):
    return in_micros(features.tx_counts(transactions(spark, sf_dir)))


def f02_amount_stats(spark, sf_dir):
    return in_micros(_amounts(transactions(spark, sf_dir)))


def f03_country_risk(spark, sf_dir):
    return in_micros(features.country_mismatch(transactions(spark, sf_dir), _profiles(spark, sf_dir)))


def f04_velocity(spark, sf_dir):
    return in_micros(features.velocity(transactions(spark, sf_dir)))


def f05_device_change(spark, sf_dir):
    return in_micros(features.device_change(transactions(spark, sf_dir)))


def f05_known_devices(spark, sf_dir):
    changes = features.device_change(transactions(spark, sf_dir), known_devices=True)
    return in_micros(changes.select(
        "user_id", "window_end", "distinct_devices", F.array_join("known_devices", ",").alias("known_devices")))


def f06_failed_attempts(spark, sf_dir):
    return in_micros(features.failed_attempts(transactions(spark, sf_dir)))


def f07_tumbling_velocity(spark, sf_dir):
    tx = transactions(spark, sf_dir).select(
        "user_id", "transaction_id", "amount_cents", "status", "device_id", "event_time")
    return in_micros(features.tumbling_velocity(tx))


def amount_ratio(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    joined = tables.with_amount_ratio(
        tx.select("transaction_id", "user_id", "amount", "event_time"), _amounts(tx, "1 hour", "5 minutes"))
    return in_micros(joined)


def online_latest(spark, sf_dir):
    """Each user's newest activity window, through an online table of two batches."""
    view = ONLINE_VIEWS["tx_5min"]
    counts = features.tx_counts(transactions(spark, sf_dir))
    path = streams.shared_folder(spark, "online")
    middle = F.lit("2024-01-01 01:00:00").cast("timestamp")
    written = F.col("window_end")
    store.write_online(counts.where(F.col("window_end") <= middle), view, path, 0, written, "1 minute")
    store.write_online(counts.where(F.col("window_end") > middle), view, path, 1, written, "1 minute")
    live = store.read_online(spark, view, path, "2024-01-01 01:59:00")
    return in_micros(live.select("user_id", "window_end", *view.names, "last_event_time", "expires_at", "batch_id"))


def online_lookup(spark, sf_dir):
    requests = transactions(spark, sf_dir).select("transaction_id", "user_id")
    return scored.scoring_features(
        requests,
        _live(_user_features(spark, sf_dir, current_only=True), USER_FEATURES, "1 minute"),
        _live(_tx_features(spark, sf_dir), TRANSACTION_FEATURES),
    )


def multi_get(spark, sf_dir):
    """Velocity of every customer, most of whom have none."""
    view = ONLINE_VIEWS["velocity"]
    live = _live(features.velocity(transactions(spark, sf_dir)), view, "1 minute", "window_end")
    customers = adapter.table(spark, sf_dir, "customer").selectExpr("'user-' || c_custkey as user_id")
    return store.from_json_value(store.multi_get(live, view, customers), view).drop("value")


def user_features_wide(spark, sf_dir):
    return in_micros(_user_features(spark, sf_dir))


def user_features_joined(spark, sf_dir):
    """The same table from the five separate features."""
    tx = transactions(spark, sf_dir)
    return in_micros(tables.build_user_features(
        features.tx_counts(tx), _amounts(tx), features.velocity(tx),
        features.device_change(tx), features.failed_attempts(tx)))


def transaction_features(spark, sf_dir):
    return in_micros(_tx_features(spark, sf_dir))


def labels_in_range(spark, sf_dir):
    return in_micros(labels_between(adapter.label_table(spark, sf_dir), LABELS_FROM, LABELS_TO))


def training_dataset(spark, sf_dir):
    return in_micros(tables.training_dataset(
        adapter.label_table(spark, sf_dir), _user_features(spark, sf_dir), _tx_features(spark, sf_dir),
        "2024-01-01 00:30:00", "2024-01-01 01:45:00"))


def feature_vector(spark, sf_dir):
    return scoring.numeric_features(online_lookup(spark, sf_dir).drop("hard_block", "country_mismatch_flag"))


def _formula_model() -> PipelineModel:
    """A model of fixed formula stages, a linear score of whole ten-thousandths, that SQL can restate."""
    points = (
        "400 * coalesce(tx_last_5min_total, 0) + 900 * coalesce(tx_last_5min_failed, 0) "
        "+ 500 * coalesce(failed_attempts_30min, 0) + 1500 * cast(coalesce(device_change_flag, false) as int) "
        "+ cast(round(coalesce(velocity_score, 0.0D) * 10000) as bigint) "
        "+ cast(round(coalesce(country_risk_score, 0.0D) * 5000) as bigint)"
    )
    scored = f"least(10000, {points}) / 10000.0D"
    return PipelineModel([
        SQLTransformer(statement=f"SELECT *, 1.0D - {scored} AS _p0, {scored} AS _p1 FROM __THIS__"),
        VectorAssembler(inputCols=["_p0", "_p1"], outputCol="probability"),
    ])


def model_scores(spark, sf_dir):
    return scoring.score(online_lookup(spark, sf_dir), _formula_model()).select("transaction_id", "user_id", "score")


def decisions(spark, sf_dir):
    return scoring.decide(scoring.score(online_lookup(spark, sf_dir), _formula_model())).select(
        "transaction_id", "user_id", "hard_block", "score", "decision")


def routed_alerts(spark, sf_dir):
    messages = scored.alert_messages(decisions(spark, sf_dir))
    text = F.col("value").cast("string")
    return messages.select(
        "topic", F.col("key").cast("string").alias("key"),
        F.get_json_object(text, "$.transaction_id").alias("transaction_id"),
        F.get_json_object(text, "$.score").cast("double").alias("score"),
        F.get_json_object(text, "$.decision").alias("decision"))


def pk_violations(spark, sf_dir):
    """Label rows keyed by user and minute are not unique; the report names every such key."""
    labels = adapter.label_table(spark, sf_dir).select(
        "user_id", F.expr("unix_micros(event_timestamp) div 60000000").alias("minute"))
    return quality.check_primary_key(labels, ("user_id", "minute"))


def constraint_violations(spark, sf_dir):
    """Label rules over rows of which some miss the user or hold a label beyond the domain."""
    labels = adapter.transactions(spark, sf_dir).selectExpr(
        "transaction_id", "case when k <> 57 then user_id end as user_id",
        "case when k <> 41 then k % 3 end as label", "event_time as event_timestamp")
    return quality.check_constraints(labels, quality.CONSTRAINTS["labeled_transactions"])


def stream_tx_counts(spark, sf_dir):
    """F01 as a stream in append mode: the windows closed by the final watermark."""
    tx = conform.with_watermark(adapter.from_events(adapter.event_stream(spark, sf_dir)))
    path = streams.shared_folder(spark, "stream-counts")
    query = (
        features.tx_counts(tx).writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start(f"{path}/rows")
    )
    query.awaitTermination()
    return in_micros(spark.read.parquet(f"{path}/rows"))


def stream_velocity_online(spark, sf_dir):
    """F04 as a stream in update mode into the online table, then every user's current score."""
    tx = conform.with_watermark(adapter.from_events(adapter.event_stream(spark, sf_dir)))
    path = streams.shared_folder(spark, "stream-velocity")
    streams.start_feature(
        "f04", tx, f"{path}/online", f"{path}/checkpoints", trigger={"availableNow": True}, written_at=AS_OF,
        partitions=streams.partitions_for(adapter.table(spark, sf_dir, "events").count(), spark),
    ).awaitTermination()
    view = ONLINE_VIEWS["velocity"]
    live = store.read_online(spark, view, f"{path}/online", "2024-01-01 02:04:59")
    return in_micros(live.select("user_id", "window_end", *view.names, "last_event_time"))


def tx_decoded_timestamps(spark, sf_dir):
    """Messages whose writer has a timestamp for the event time; it arrives as epoch milliseconds."""
    decoded = decode_transactions(
        split_wire_frame(adapter.timestamp_frames(spark, sf_dir)),
        {adapter.CURRENT_SCHEMA_ID: adapter.timestamp_schema()})
    return decoded.select("transaction_id", "amount", "event_time", "decode_error")


def stream_rejects(spark, sf_dir):
    """Every message of a stream ends in one of two tables; the reason is null for valid ones."""
    events = adapter.from_events(adapter.event_stream(spark, sf_dir))
    frames = adapter.frames_of(adapter.flawed(events.withColumn("event_time", F.expr("event_us div 1000"))))
    path = streams.shared_folder(spark, "stream-rejects")
    streams.start_ingest(
        frames, adapter.writer_schemas(), f"{path}/good", f"{path}/rejected", f"{path}/checkpoint",
        trigger={"availableNow": True}).awaitTermination()
    good = spark.read.parquet(f"{path}/good").select("event_id", F.lit(None).cast("string").alias("reject_reason"))
    return good.unionByName(spark.read.parquet(f"{path}/rejected").select("event_id", "reject_reason"))


def online_user_row(spark, sf_dir):
    """The five user features as one stream of panes into their online tables, then one live row per user."""
    # Sums of whole cents are exact in any order.
    tx = adapter.from_events(adapter.event_stream(spark, sf_dir)).withColumn("cents", F.col("amount_cents").cast("double"))
    path = streams.shared_folder(spark, "online-user")
    chosen = panes.PANE_FEATURES | {"f02": panes.amounts_feature("cents")}
    online = {name: f"{path}/online/{name}" for name in chosen}
    panes.start_pane_features(
        tx, chosen, f"{path}/panes", online, f"{path}/checkpoint", trigger={"availableNow": True}, written_at=AS_OF,
    ).awaitTermination()
    row = store.online_user_features(
        spark, {feature.view.name: online[name] for name, feature in chosen.items()}, "2024-01-01 02:04:59")
    return row.withColumn("avg_amount_24h", F.col("avg_amount_24h") / 100).withColumn(
        "stddev_amount_24h", F.round(F.col("stddev_amount_24h") / 100, 4))


def training_from_store(spark, sf_dir):
    """Both feature tables pushed to the store, and the training set read back from its history."""
    start, end = "2024-01-01 00:30:00", "2024-01-01 01:45:00"
    path = streams.shared_folder(spark, "offline")
    user, tx = f"{path}/user", f"{path}/transaction"
    store.push_features(_user_features(spark, sf_dir), USER_FEATURES, f"{user}/on", f"{user}/off", 0, AS_OF, "1 minute")
    store.push_features(_tx_features(spark, sf_dir), TRANSACTION_FEATURES, f"{tx}/on", f"{tx}/off", 0, AS_OF)
    return in_micros(tables.training_dataset(
        adapter.label_table(spark, sf_dir),
        store.read_offline(spark, USER_FEATURES, f"{user}/off", "2023-12-31 00:30:00", end),
        store.read_offline(spark, TRANSACTION_FEATURES, f"{tx}/off", "2024-01-01 00:20:00", end),
        start, end))


def online_compacted(spark, sf_dir):
    """Four batches of which three are folded; the read takes the folded table and the fourth batch."""
    view = ONLINE_VIEWS["tx_5min"]
    counts = features.tx_counts(transactions(spark, sf_dir))
    path = streams.shared_folder(spark, "compacted")
    minute = F.expr("(unix_micros(window_end) - 1704067200000000) div 60000000")
    for batch in range(4):
        part = counts.where(F.least(F.lit(3), minute.cast("bigint") / 30).cast("int") == batch)
        store.write_online(part, view, f"{path}/running", batch, F.col("window_end"), "1 minute")
        if batch == 2:
            folded = store.compact_online(spark, view, f"{path}/running", f"{path}/folded", "2024-01-01 01:30:00")
    live = store.read_online(
        spark, view, [f"{path}/folded", f"{path}/running"], "2024-01-01 01:59:00", folded)
    return in_micros(live.select("user_id", "window_end", *view.names, "last_event_time", "expires_at"))


def stream_velocity_panes(spark, sf_dir):
    """F04 as a stream of panes: 60 window copies of an event less than ``stream_velocity_online``, the same scores."""
    tx = adapter.from_events(adapter.event_stream(spark, sf_dir))
    path = streams.shared_folder(spark, "stream-panes")
    panes.start_pane_feature(
        "f04", tx, f"{path}/panes", f"{path}/online", f"{path}/checkpoints", trigger={"availableNow": True},
        written_at=AS_OF).awaitTermination()
    view = ONLINE_VIEWS["velocity"]
    live = store.read_online(spark, view, f"{path}/online", "2024-01-01 02:04:59")
    return in_micros(live.select("user_id", "window_end", *view.names, "last_event_time"))


def _appended(df: DataFrame, path: str, spark: SparkSession) -> DataFrame:
    df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(
        availableNow=True).start(f"{path}/rows").awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def stream_tumbling(spark, sf_dir):
    """F07 as a stream: the windows that the 10-second watermark has closed, by the writer of the debugging sink."""
    tx = adapter.from_events(adapter.event_stream(spark, sf_dir)).select(
        "user_id", "transaction_id", "amount_cents", "status", "device_id", "event_time")
    path = streams.shared_folder(spark, "stream-tumbling")
    streams.start_tumbling_velocity(
        streams.tumbling_input(tx), f"{path}/checkpoint", "parquet", {"availableNow": True}, path=f"{path}/rows",
    ).awaitTermination()
    return in_micros(spark.read.parquet(f"{path}/rows"))


def stream_country_risk(spark, sf_dir):
    """F03 as a stream in append mode, one row per transaction."""
    tx = adapter.from_events(adapter.event_stream(spark, sf_dir))
    risk = features.country_mismatch(tx, _profiles(spark, sf_dir))
    return in_micros(_appended(risk, streams.shared_folder(spark, "stream-risk"), spark))


def _deliveries(tx: DataFrame, parts: list, path: str):
    """Deliver parts (conditions) of ``tx`` one after the other to a folder; yields the folder's stream each time, whose
    next micro-batch is the whole delivery, in as many files as it has.
    """
    for part in parts:
        tx.where(part).write.mode("append").parquet(path)
        yield tx.sparkSession.readStream.schema(tx.schema).parquet(path)


def stream_dedup(spark, sf_dir):
    """All transactions delivered twice, in two micro-batches; each counts once in the users' newest F01 window."""
    path = streams.shared_folder(spark, "stream-dedup")
    tx = transactions(spark, sf_dir).select("transaction_id", "user_id", "status", "event_time")
    for delivered in _deliveries(tx, [F.lit(True)] * 2, f"{path}/delivered"):
        streams.start_feature(
            "f01", conform.dedupe_transactions(conform.with_watermark(delivered)), f"{path}/online", f"{path}/checkpoints",
            trigger={"availableNow": True}, written_at=AS_OF).awaitTermination()
    view = ONLINE_VIEWS["tx_5min"]
    live = store.read_online(spark, view, f"{path}/online", "2024-01-01 02:04:59")
    return in_micros(live.select("user_id", "window_end", *view.names, "last_event_time"))


def _shares(count: int) -> list:
    """Conditions that deal transactions out at random: each delivery holds rows older than those before it."""
    return [F.pmod(F.xxhash64("transaction_id"), F.lit(count)) == i for i in range(count)]


def stream_amount_panes(spark, sf_dir):
    """F02 as a stream of panes over four deliveries, each with late rows; the current value of every user."""
    tx = transactions(spark, sf_dir).select(
        "transaction_id", "user_id", "status", F.col("amount_cents").cast("double").alias("amount"), "event_time")
    path = streams.shared_folder(spark, "stream-amounts")
    for delivered in _deliveries(tx, _shares(4), f"{path}/delivered"):
        panes.start_pane_feature(
            "f02", delivered, f"{path}/panes", f"{path}/online", f"{path}/checkpoints", {"availableNow": True}, AS_OF,
        ).awaitTermination()
    view = ONLINE_VIEWS["avg_amount_24h"]
    live = store.read_online(spark, view, f"{path}/online", "2024-01-01 02:04:59")
    return in_micros(_cents(live.select("user_id", "window_end", *view.names, "last_event_time")))


def _device_stream(spark, sf_dir):
    tx = transactions(spark, sf_dir).select("transaction_id", "user_id", "device_id", "event_time")
    path = streams.shared_folder(spark, "stream-devices")
    for delivered in _deliveries(tx, _shares(4), f"{path}/delivered"):
        panes.start_pane_feature(
            "f05", delivered, f"{path}/panes", f"{path}/online", f"{path}/checkpoints", {"availableNow": True}, AS_OF,
            members_path=f"{path}/devices").awaitTermination()
    return store.read_online(spark, ONLINE_VIEWS["device_change"], f"{path}/online", "2024-01-01 02:04:59"), f"{path}/devices"


def stream_device_panes(spark, sf_dir):
    """F05 as a stream of panes over four deliveries, without a set of devices; the current value of every user."""
    live, _ = _device_stream(spark, sf_dir)
    return in_micros(live.select("user_id", "window_end", *ONLINE_VIEWS["device_change"].names, "last_event_time"))


def stream_known_devices(spark, sf_dir):
    """The devices of every user's current F05 window on a stream, one row each."""
    return in_micros(panes.read_members(*_device_stream(spark, sf_dir)))


def stream_scoring(spark, sf_dir):
    """Requests in two deliveries to one running scorer; the features after one o'clock are written in between, and count
    for the second.
    """
    path = streams.shared_folder(spark, "stream-scoring")
    requests = transactions(spark, sf_dir).select("transaction_id", "user_id", "event_time")
    users, tx = f"{path}/users", f"{path}/transactions"
    # Computed once for both deliveries; ``write_online`` would drop rows that are nobody's current ones only afterwards.
    user_rows = _stored(_user_features(spark, sf_dir, current_only=True), f"{path}/user_rows")
    tx_rows = _tx_features(spark, sf_dir)
    earlier = "event_timestamp <= timestamp'2024-01-01 01:00:00'"
    query = None
    for batch, part in enumerate((earlier, f"not {earlier}")):
        store.write_online(user_rows.where(part), USER_FEATURES, users, batch, F.col("event_timestamp"), "1 minute")
        store.write_online(tx_rows.where(part), TRANSACTION_FEATURES, tx, batch, F.col("event_timestamp"))
        requests.where(part.replace("event_timestamp", "event_time")).write.mode("append").parquet(f"{path}/requests")
        if query is None:
            delivered = spark.readStream.schema(requests.schema).parquet(f"{path}/requests")
            query = scorer.start_scorer(
                delivered, scorer.stored_features(users, tx), f"{path}/decisions", f"{path}/checkpoint", _formula_model())
        query.processAllAvailable()
    query.stop()
    return spark.read.parquet(f"{path}/decisions").select("transaction_id", "user_id", "hard_block", "score", "decision")


def stream_dedup_history(spark, sf_dir):
    """Half of the transactions, then all, then all again: each once, with the number of the delivery that counts."""
    path = streams.shared_folder(spark, "stream-history")
    tx = transactions(spark, sf_dir).select("transaction_id", "user_id", "k", "event_time")
    for delivered in _deliveries(tx, [F.col("k") % 2 == 0, F.lit(True), F.lit(True)], f"{path}/delivered"):
        streams.start_history_dedup(
            delivered, f"{path}/rows", f"{path}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    rows = spark.read.parquet(f"{path}/rows")
    return rows.select("transaction_id", "user_id", F.col("batch_id").cast("bigint").alias("batch_id"))


def stream_late_rows(spark, sf_dir):
    """All transactions in four deliveries of all times: which are on time, and how late the others are."""
    path = streams.shared_folder(spark, "stream-late")
    tx = transactions(spark, sf_dir).select("transaction_id", "k", "event_time")
    for delivered in _deliveries(tx, [F.col("k") % 4 == i for i in range(4)], f"{path}/delivered"):
        streams.start_late_split(
            delivered, f"{path}/good", f"{path}/late", f"{path}/seen", f"{path}/checkpoint", trigger={"availableNow": True},
        ).awaitTermination()
    good = spark.read.parquet(f"{path}/good").withColumn("lateness_us", F.lit(None).cast("bigint"))
    return good.unionByName(spark.read.parquet(f"{path}/late")).select("transaction_id", "lateness_us")


def _much_flawed(spark, sf_dir):
    """Records of which some violate several rules at once."""
    return adapter.flawed_records(spark, sf_dir).withColumn(
        "merchant_country", F.expr("case when k <> 41 then merchant_country end")).withColumn(
        "amount", F.expr("case when k <> 29 then amount end"))


def tx_violations(spark, sf_dir):
    """All rules that a record violates."""
    judged = conform.with_violations(_much_flawed(spark, sf_dir)).where("size(violations) > 0")
    return judged.select("event_id", F.array_join("violations", ",").alias("violations"))


def violation_counts(spark, sf_dir):
    """How many records violate each rule, counted in the pass that writes them."""
    path = streams.shared_folder(spark, "violations")
    judged, seen = conform.count_violations(conform.with_violations(_much_flawed(spark, sf_dir)).select(
        *conform.REQUIRED_FIELDS, "violations"))
    judged.write.parquet(path)
    return spark.createDataFrame(list(seen.get.items()), "rule string, violations bigint")


def created_at(spark, sf_dir):
    return in_micros(quality.with_created_at(_tx_features(spark, sf_dir), AS_OF))


def key_values(spark, sf_dir):
    """Every user's velocity as key and value, with its TTL and its time as text."""
    view = ONLINE_VIEWS["velocity"]
    rows = store.key_values(features.velocity(transactions(spark, sf_dir)), view)
    return store.from_json_value(rows, view).drop("value").withColumn("ttl_seconds", F.col("ttl_seconds").cast("bigint"))


def tx_decoded_registry(spark, sf_dir):
    """Messages of 200 writers, decoded with one parse."""
    registry = schema_registry(spark, adapter.many_writers())
    decoded = decode_registered(split_wire_frame(adapter.frames_of_many(spark, sf_dir)), registry)
    return decoded.select(
        "event_id", "decode_error", F.col("_schema_id").cast("bigint").alias("schema_id"), "transaction_id",
        "user_id", "amount", "currency", "device_id", "status", "event_time",
        F.col("metadata")["k"].alias("metadata_k"))


def store_commits(spark, sf_dir):
    """Three batches of which the second one fails between its two writes: what the online table and the history show
    then, and after it is pushed again.
    """
    path = streams.shared_folder(spark, "commits")
    on, off, commits = f"{path}/on", f"{path}/off", f"{path}/commits"
    risks = _tx_features(spark, sf_dir)
    third = F.pmod(F.unix_micros("event_timestamp"), F.lit(3))

    def push(batch):
        store.push_features(risks.where(third == batch), TRANSACTION_FEATURES, on, off, batch, AS_OF, commits=commits)

    def shown(state):
        live = store.read_online(spark, TRANSACTION_FEATURES, on, AS_OF, commits=commits)
        kept = store.read_offline(spark, TRANSACTION_FEATURES, off, commits=commits)
        return [
            rows.select("transaction_id", "country_risk_score", F.lit(side).alias("side"), F.lit(state).alias("state"))
            for side, rows in (("online", live), ("offline", kept))]

    push(0)
    store.write_offline(risks.where(third == 1), off, 1)
    push(2)
    online, offline = shown("failed")
    for batch in (0, 1):
        push(batch)
    again = shown("pushed again")
    return online.unionByName(offline).unionByName(again[0]).unionByName(again[1])


def online_bucketed(spark, sf_dir):
    """The newest activity of each transaction's user, from a table of two batches bucketed by user."""
    view = ONLINE_VIEWS["tx_5min"]
    tx = transactions(spark, sf_dir)
    counts = features.tx_counts(tx)
    name = f"online_{uuid.uuid4().hex}"
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bucketed.create_bucketed(spark, view, name, counts, streams.shared_folder(spark, "bucketed"), buckets)
    early = F.col("window_end") <= F.lit("2024-01-01 01:00:00").cast("timestamp")
    for batch, part in enumerate((early, ~early)):
        bucketed.write_bucketed(counts.where(part), view, name, batch, F.col("window_end"), "1 minute")
    live = bucketed.read_bucketed(spark, view, name, "2024-01-01 01:59:00")
    return store.get_online_features(tx.select("transaction_id", "user_id"), [(view, live, None)])


def fitted_scores(spark, sf_dir):
    """Features pushed to the store; a model fitted on the history, saved, loaded, and applied to every request with the
    features online.
    """
    start, end = "2024-01-01 00:30:00", "2024-01-01 01:45:00"
    path = streams.shared_folder(spark, "fitted")
    known = F.col("event_timestamp")
    live, history = [], []
    for rows, view, slide in ((_user_features(spark, sf_dir), USER_FEATURES, "1 minute"),
                              (_tx_features(spark, sf_dir), TRANSACTION_FEATURES, None)):
        on, off = f"{path}/{view.name}/on", f"{path}/{view.name}/off"
        store.push_features(rows, view, on, off, 0, known, slide)
        live.append(store.read_online(spark, view, on, AS_OF))
        history.append(store.read_offline(spark, view, off, "2023-12-31 00:30:00", end))
    training = tables.training_dataset(
        adapter.label_table(spark, sf_dir), *history, start, end, SCORING_USER_FEATURES)
    risk_model.fit_risk_model(training).write().overwrite().save(f"{path}/model")
    requests = transactions(spark, sf_dir).select("transaction_id", "user_id")
    return scoring.score(
        scored.scoring_features(requests, *live), PipelineModel.load(f"{path}/model")).select(
        "transaction_id", "user_id", "score")


QUERIES = {
    f.__name__: f
    for f in (
        tx_conformed, tx_rejected, wire_frame_split, tx_decoded, tx_publish_roundtrip, tx_dedup,
        f01_tx_counts, f02_amount_stats, f03_country_risk, f04_velocity, f05_device_change, f05_known_devices,
        f06_failed_attempts, f07_tumbling_velocity, amount_ratio,
        online_latest, online_lookup, multi_get,
        user_features_wide, user_features_joined, transaction_features, labels_in_range, training_dataset,
        feature_vector, decisions, routed_alerts, pk_violations, constraint_violations,
        stream_tx_counts, stream_velocity_online,
        tx_decoded_timestamps, stream_rejects, online_user_row, training_from_store, online_compacted, model_scores,
        stream_tumbling, stream_country_risk, stream_dedup, created_at, key_values, stream_velocity_panes,
        stream_scoring, stream_amount_panes, stream_device_panes, stream_known_devices,
        stream_dedup_history, stream_late_rows, tx_violations, violation_counts,
        tx_decoded_registry, store_commits, online_bucketed, fitted_scores,
    )
}
