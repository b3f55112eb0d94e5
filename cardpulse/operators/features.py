"""The risk features F01 to F07. Each takes transactions with an ``event_time`` timestamp, batch or streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.functions import scalars
from cardpulse.functions.times import micros
from cardpulse.operators.skew import lookup_join
from cardpulse.operators.windows import (
    Tally,
    sliding_amounts,
    sliding_distinct,
    sliding_members,
    sliding_tallies,
    with_windows,
)
from cardpulse.schema import FAILED_LIMIT, SMALL_AMOUNT, SMALL_FAILED_LIMIT

_BOUNDS = ("user_id", "window_start", "window_end")

APPROVED = "status = 'APPROVED'"
FAILED = "status = 'FAILED'"
SMALL_FAILED = f"{FAILED} and amount < {SMALL_AMOUNT}D"


def hard_block(failed_count: str = "failed_count", small_amount_fails: str = "small_amount_fails") -> Column:
    """Credential stuffing or card testing."""
    return (F.col(failed_count) > FAILED_LIMIT) | (F.col(small_amount_fails) > SMALL_FAILED_LIMIT)


def count_tallies(window: str = "5 minutes") -> list[Tally]:
    return [Tally("total_tx", window), Tally("approved_tx", window, APPROVED), Tally("failed_tx", window, FAILED)]


def tx_counts(tx: DataFrame, window: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """all, approved and failed transactions of a user."""
    return sliding_tallies(tx, count_tallies(window), slide)


def amount_stats(
    tx: DataFrame, window: str = "24 hours", slide: str = "1 hour", amount: str = "amount"
) -> DataFrame:
    """statistics of a user's approved amounts."""
    return sliding_amounts(tx.where(APPROVED), window, slide, amount)


def enrich_profiles(tx: DataFrame, profiles: DataFrame, spread: int = 1) -> DataFrame:
    """Add ``home_country``, null for a user without a profile; one profile per user.

    The profile table grows with the users; Spark broadcasts it only while small. On a stream with a large one,
    ``spread`` deals busy users out.
    """
    home = profiles.select("user_id", "home_country")
    return lookup_join(tx, home, ["user_id"], spread)


def country_mismatch(tx: DataFrame, profiles: DataFrame, spread: int = 1) -> DataFrame:
    """risk of each transaction from its merchant's country and the user's home country."""
    needed = tx.select("transaction_id", "user_id", "merchant_country", "event_time")
    risk = scalars.country_risk("merchant_country", "home_country")
    return enrich_profiles(needed, profiles, spread).withColumn("_risk", risk).select(
        "transaction_id", "user_id", "event_time", "_risk.mismatch", "_risk.risk_score", "_risk.is_unusual")


def velocity(
    tx: DataFrame,
    short: str = "1 minute",
    middle: str = "5 minutes",
    window: str = "1 hour",
    slide: str = "1 minute",
) -> DataFrame:
    """burst score from three counts that all end at ``window_end``."""
    return velocity_of(sliding_tallies(tx, velocity_tallies(short, middle, window), slide))


def velocity_tallies(short: str = "1 minute", middle: str = "5 minutes", window: str = "1 hour") -> list[Tally]:
    return [Tally("cnt_1m", short), Tally("cnt_5m", middle), Tally("cnt_1h", window)]


def velocity_of(counts: DataFrame) -> DataFrame:
    return counts.select(
        *_BOUNDS, "cnt_1m", "cnt_5m", "cnt_1h",
        scalars.velocity("cnt_1m", "cnt_5m", "cnt_1h").alias("velocity_score"),
        "last_event_time",
    )


def device_change(
    tx: DataFrame, window: str = "24 hours", slide: str = "1 hour", known_devices: bool = False
) -> DataFrame:
    """distinct devices of a user. ``known_devices`` adds the sorted array of them.

    A batch input counts without building sets unless the array is asked for; a streaming input keeps the set in
    its state, as exact distinct counting over a stream needs.
    """
    used = tx.where(F.col("device_id").isNotNull())
    if tx.isStreaming:
        rows = with_windows(used, micros(window), micros(slide), "user_id", "event_time")
        counted = rows.groupBy("user_id", "_w").agg(
            F.array_sort(F.collect_set("device_id")).alias("known_devices"),
            F.max("event_time").alias("last_event_time"),
        ).select(
            "user_id", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
            "known_devices", F.size("known_devices").cast("bigint").alias("distinct_devices"), "last_event_time")
    elif known_devices:
        counted = sliding_members(used, "device_id", window, slide).groupBy(*_BOUNDS).agg(
            F.array_sort(F.collect_list("device_id")).alias("known_devices"),
            F.count("*").alias("distinct_devices"),
            F.max("last_event_time").alias("last_event_time"),
        )
    else:
        counted = sliding_distinct(used, "device_id", window, slide, "distinct_devices")
    return devices_of(counted, known_devices)


def devices_of(counted: DataFrame, known_devices: bool = False) -> DataFrame:
    """F05's columns from the number of devices."""
    return counted.select(
        *_BOUNDS,
        *(["known_devices"] if known_devices else []),
        "distinct_devices",
        (F.col("distinct_devices") > 1).alias("device_change_flag"),
        scalars.device_score("distinct_devices").alias("device_score"),
        "last_event_time",
    )


def failed_attempts(tx: DataFrame, window: str = "30 minutes", slide: str = "5 minutes") -> DataFrame:
    """failure counts of a user and the flags for credential stuffing and card testing."""
    return failures_of(sliding_tallies(tx, failure_tallies(window), slide))


def failure_tallies(window: str = "30 minutes") -> list[Tally]:
    return [
        Tally("failed_count", window, FAILED),
        Tally("declined_count", window, "status = 'DECLINED'"),
        Tally("insufficient_funds", window, "failure_reason = 'INSUFFICIENT_FUNDS'"),
        Tally("card_blocked", window, "failure_reason = 'CARD_BLOCKED'"),
        Tally("small_amount_fails", window, SMALL_FAILED),
    ]


def failures_of(counts: DataFrame) -> DataFrame:
    return counts.select(
        *_BOUNDS, "failed_count", "declined_count", "insufficient_funds", "card_blocked", "small_amount_fails",
        (F.col("failed_count") > FAILED_LIMIT).alias("credential_stuffing"),
        (F.col("small_amount_fails") > SMALL_FAILED_LIMIT).alias("card_testing"),
        hard_block().alias("hard_block"),
        "last_event_time",
    )


def tumbling_velocity(tx: DataFrame, window: str = "1 minute") -> DataFrame:
    """transactions of a user per tumbling window, with the fields of the earliest of them."""
    fields = [c for c in tx.columns if c != "user_id"]
    first = F.min_by(F.struct(*fields), F.struct("event_time", "transaction_id"))
    return (
        tx.groupBy("user_id", F.window("event_time", window).alias("_w"))
        .agg(F.count("*").alias("count"), first.alias("_first"))
        .select(
            "user_id",
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "count",
            *[F.col(f"_first.{c}").alias(c) for c in fields],
        )
    )
