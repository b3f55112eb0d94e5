"""Column layouts, feature views and the fixed values every operator shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The record layout.
TX_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_country", T.StringType()),
    T.StructField("user_country", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("_schema_id", T.IntegerType()),
])

# The wire contract.
REQUIRED_FIELDS = (
    "transaction_id", "user_id", "amount", "merchant_id",
    "merchant_country", "user_country", "status", "event_time",
)
STATUSES = ("APPROVED", "FAILED", "DECLINED", "PENDING")
DEFAULT_CURRENCY = "EUR"

# Topics, decisions and thresholds.
RAW_TOPIC = "raw-transactions"
ALERT_TOPIC = "fraud-alerts"
CLEARED_TOPIC = "cleared-transactions"
ALERT_THRESHOLD = 0.85
FAILED_LIMIT = 10
SMALL_AMOUNT = 5.0
SMALL_FAILED_LIMIT = 3
RISKY_PAIRS = (("NG", "US"), ("RO", "GB"), ("CN", "DE"))  # (merchant country, home country)

# Lateness allowed to an event.
WATERMARK = "10 minutes"
TUMBLING_WATERMARK = "10 seconds"

# Seconds an online value stays live.
ONLINE_TTL = {
    "tx_5min": 600,
    "avg_amount_24h": 86400,
    "country_mismatch": 300,
    "velocity": 300,
    "device_change": 86400,
    "failed_attempts": 1800,
}
DEFAULT_TTL = 600

# Order of the model's inputs.
FEATURE_ORDER = (
    "tx_last_5min_total",
    "tx_last_5min_failed",
    "avg_amount_24h",
    "velocity_score",
    "device_change_flag",
    "failed_attempts_30min",
    "country_risk_score",
)

# Features read by a scoring request and by a training set.
SCORING_USER_FEATURES = (
    "tx_last_5min_total", "tx_last_5min_failed", "avg_amount_24h", "velocity_score",
    "device_change_flag", "failed_attempts_30min", "hard_block",
)
SCORING_TX_FEATURES = ("country_mismatch_flag", "country_risk_score")
TRAINING_USER_FEATURES = ("avg_amount_24h", "velocity_score", "device_change_flag")
TRAINING_TX_FEATURES = ("country_risk_score",)

# Newest event first; among windows holding it, the one that ends first (the trailing window).
WINDOW_RECENCY = ("last_event_time", "-unix_micros(window_end)")


@dataclass(frozen=True)
class FeatureView:
    """A named set of feature columns for one entity, with the time a value stays usable.

    ``recency`` are the SQL expressions, most significant first, that tell which of an entity's rows is its
    current value.
    """

    name: str
    entity: tuple[str, ...]
    ttl_seconds: int
    columns: tuple[tuple[str, str], ...]
    recency: tuple[str, ...] = WINDOW_RECENCY

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]


USER_FEATURES = FeatureView(
    "user_features", ("user_id",), 24 * 3600,
    (
        ("tx_last_5min_total", "bigint"),
        ("tx_last_5min_approved", "bigint"),
        ("tx_last_5min_failed", "bigint"),
        ("avg_amount_24h", "double"),
        ("stddev_amount_24h", "double"),
        ("velocity_score", "double"),
        ("distinct_devices_24h", "bigint"),
        ("device_change_flag", "boolean"),
        ("failed_attempts_30min", "bigint"),
        ("hard_block", "boolean"),
    ),
    recency=("last_event_time", "-unix_micros(event_timestamp)"),
)
TRANSACTION_FEATURES = FeatureView(
    "transaction_features", ("transaction_id",), 10 * 60,
    (
        ("country_mismatch_flag", "boolean"),
        ("country_risk_score", "double"),
        ("is_unusual_country", "boolean"),
    ),
    recency=("event_timestamp",),
)

# One view per online feature; its TTL is the one of the key.
ONLINE_VIEWS = {
    "tx_5min": FeatureView(
        "tx_5min", ("user_id",), ONLINE_TTL["tx_5min"],
        (("total_tx", "bigint"), ("approved_tx", "bigint"), ("failed_tx", "bigint"))),
    "avg_amount_24h": FeatureView(
        "avg_amount_24h", ("user_id",), ONLINE_TTL["avg_amount_24h"],
        (("avg_amount", "double"), ("stddev_amount", "double"), ("max_amount", "double"),
         ("min_amount", "double"), ("sum_amount", "double"))),
    "country_mismatch": FeatureView(
        "country_mismatch", ("transaction_id",), ONLINE_TTL["country_mismatch"],
        (("mismatch", "boolean"), ("risk_score", "double"), ("is_unusual", "boolean")),
        recency=("event_time",)),
    "velocity": FeatureView(
        "velocity", ("user_id",), ONLINE_TTL["velocity"],
        (("velocity_score", "double"), ("cnt_1m", "bigint"), ("cnt_5m", "bigint"), ("cnt_1h", "bigint"))),
    "device_change": FeatureView(
        "device_change", ("user_id",), ONLINE_TTL["device_change"],
        (("device_change_flag", "boolean"), ("distinct_devices", "bigint"), ("device_score", "double"))),
    "failed_attempts": FeatureView(
        "failed_attempts", ("user_id",), ONLINE_TTL["failed_attempts"],
        (("failed_count", "bigint"), ("declined_count", "bigint"), ("insufficient_funds", "bigint"),
         ("card_blocked", "bigint"), ("small_amount_fails", "bigint"), ("credential_stuffing", "boolean"),
         ("card_testing", "boolean"), ("hard_block", "boolean"))),
}
