"""Wide feature tables and training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardpulse.functions.scalars import amount_ratio, velocity
from cardpulse.functions.times import micros
from cardpulse.operators import features
from cardpulse.operators.pointintime import SPREAD, Lookup, point_in_time_join
from cardpulse.operators.windows import Tally, sliding_tallies
from cardpulse.schema import (
    ONLINE_VIEWS,
    TRAINING_TX_FEATURES,
    TRAINING_USER_FEATURES,
    TRANSACTION_FEATURES,
    USER_FEATURES,
    FeatureView,
)
from cardpulse.sources.tables import labels_between


def _known_at_end(feature: DataFrame) -> DataFrame:
    return feature.withColumnRenamed("window_end", "event_timestamp")


def _renamed(view: FeatureView, **names: str) -> FeatureView:
    """The view's TTL and entity over the wide table's column names."""
    kinds = dict(view.columns)
    return FeatureView(view.name, view.entity, view.ttl_seconds, tuple((new, kinds[old]) for old, new in names.items()))


def _wide(feature: DataFrame, view: str, **names: str) -> Lookup:
    renamed = _known_at_end(feature).select(
        "user_id", "event_timestamp", *[F.col(old).alias(new) for old, new in names.items()])
    return Lookup(renamed, _renamed(ONLINE_VIEWS[view], **names))


def _amount_lookup(amounts: DataFrame) -> Lookup:
    return _wide(amounts, "avg_amount_24h", avg_amount="avg_amount_24h", stddev_amount="stddev_amount_24h")


def _device_lookup(devices: DataFrame) -> Lookup:
    return _wide(devices, "device_change", distinct_devices="distinct_devices_24h",
                 device_change_flag="device_change_flag")


def build_user_features(
    counts: DataFrame, amounts: DataFrame, speed: DataFrame, devices: DataFrame, failures: DataFrame
) -> DataFrame:
    """K1: one wide row per user and end of an activity window (F01), with the newest live F02, F04, F05 and F06.

    ``last_event_time`` comes along to tell a user's current row; see ``USER_FEATURES.recency``.
    """
    spine = _known_at_end(counts).select(
        "user_id", "event_timestamp",
        F.col("total_tx").alias("tx_last_5min_total"),
        F.col("approved_tx").alias("tx_last_5min_approved"),
        F.col("failed_tx").alias("tx_last_5min_failed"),
        "last_event_time",
    )
    # Every side has at most one row per user and slide step, so no slot can be hot.
    wide = point_in_time_join(spine, [
        _amount_lookup(amounts),
        _wide(speed, "velocity", velocity_score="velocity_score"),
        _device_lookup(devices),
        _wide(failures, "failed_attempts", failed_count="failed_attempts_30min", hard_block="hard_block"),
    ], spread=1)
    return wide.select("user_id", "event_timestamp", *USER_FEATURES.names, "last_event_time")


def backfill_user_features(
    tx: DataFrame, amounts: DataFrame, devices: DataFrame, current_only: bool = False
) -> DataFrame:
    """K1 straight from transactions, with F02 and F05 given: the same rows as :func:`build_user_features`.

    ``current_only`` leaves out rows that can't be their user's current one, before anything is looked up for them:
    windows whose newest event lies more than one slide back.

    F01, F04 and F06 are counts on one minute grid, so one scan and one pane shuffle serve all three. F04 ends where
    F01 ends and needs no lookup; the newest live F06 row is carried along the same sorted rows.
    """
    short, half = "5 minutes", "30 minutes"
    activity = sliding_tallies(tx, [
        Tally("cnt_1m", "1 minute"),
        Tally("tx_last_5min_total", short),
        Tally("tx_last_5min_approved", short, features.APPROVED),
        Tally("tx_last_5min_failed", short, features.FAILED),
        Tally("cnt_1h", "1 hour"),
        Tally("_rows_30m", half),
        Tally("failed_count", half, features.FAILED),
        Tally("small_amount_fails", half, features.SMALL_FAILED),
    ], "1 minute")

    ttl = ONLINE_VIEWS["failed_attempts"].ttl_seconds * 1_000_000
    on_grid = f"_rows_30m > 0 and unix_micros(window_end) % {micros(short)}L = 0"
    failures = F.when(F.expr(on_grid), F.struct(
        F.unix_micros("window_end").alias("at"), "failed_count", features.hard_block().alias("hard_block")))
    so_far = Window.partitionBy("user_id").orderBy("window_end").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    live = F.unix_micros("window_end") - F.col("_f06.at") <= ttl
    spine = (
        activity.withColumn("_f06", F.last(failures, ignorenulls=True).over(so_far))
        .where("tx_last_5min_total > 0")
        .select(
            "user_id", F.col("window_end").alias("event_timestamp"),
            "tx_last_5min_total", "tx_last_5min_approved", "tx_last_5min_failed",
            velocity("cnt_1m", "tx_last_5min_total", "cnt_1h").alias("velocity_score"),
            F.when(live, F.col("_f06.failed_count")).alias("failed_attempts_30min"),
            F.when(live, F.col("_f06.hard_block")).alias("hard_block"),
            "last_event_time",
        )
    )
    if current_only:
        spine = spine.where(
            F.unix_micros("event_timestamp") - F.unix_micros("last_event_time") <= micros("1 minute"))
    wide = point_in_time_join(spine, [_amount_lookup(amounts), _device_lookup(devices)], spread=1)
    return wide.select("user_id", "event_timestamp", *USER_FEATURES.names, "last_event_time")


def build_transaction_features(mismatch: DataFrame) -> DataFrame:
    """K2: F03 under the names of the stored table."""
    return mismatch.select(
        "transaction_id", "user_id",
        F.col("event_time").alias("event_timestamp"),
        F.col("mismatch").alias("country_mismatch_flag"),
        F.col("risk_score").alias("country_risk_score"),
        F.col("is_unusual").alias("is_unusual_country"),
    )


def training_dataset(
    labels: DataFrame,
    user_features: DataFrame,
    tx_features: DataFrame,
    start,
    end,
    user_columns: tuple[str, ...] = TRAINING_USER_FEATURES,
    tx_columns: tuple[str, ...] = TRAINING_TX_FEATURES,
    spread: int = SPREAD,
) -> DataFrame:
    """K3: labels of a closed time range with the feature values known at each label's time. Of the features, only
    those from one TTL before ``start`` to ``end`` are read.
    """
    def usable(rows, view):
        first = F.lit(start).cast("timestamp") - F.make_dt_interval(secs=F.lit(view.ttl_seconds))
        return rows.where(F.col("event_timestamp").between(first, F.lit(end).cast("timestamp")))

    return point_in_time_join(
        labels_between(labels, start, end),
        [
            Lookup(usable(user_features, USER_FEATURES), USER_FEATURES, user_columns),
            Lookup(usable(tx_features, TRANSACTION_FEATURES), TRANSACTION_FEATURES, tx_columns),
        ],
        spine_key=("transaction_id",),
        spread=spread,
    )


def with_amount_ratio(tx: DataFrame, amounts: DataFrame, spread: int = SPREAD) -> DataFrame:
    """H5: each transaction's amount relative to the user's newest known 24-hour average."""
    average = Lookup(_known_at_end(amounts), ONLINE_VIEWS["avg_amount_24h"], ("avg_amount",))
    joined = point_in_time_join(tx, [average], ts="event_time", spine_key=("transaction_id",), spread=spread)
    return joined.withColumn("amount_ratio", amount_ratio("avg_amount", "amount"))
