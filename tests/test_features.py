"""Figures of each feature, and every threshold from both sides."""

import pytest
from pyspark.sql import functions as F

from cardpulse.operators import features
from conftest import at, tx_rows


def trailing(df, user):
    """The window that ends first after the user's newest event."""
    return df.where(F.col("user_id") == user).orderBy(F.desc("last_event_time"), "window_end").first()


def row(i, user, amount, status, reason=None, device="d1", second=0.0, country="FR"):
    return (f"tx{i}", user, amount, status, reason, country, device, second)


def test_counts(spark):
    tx = tx_rows(spark, [
        row(1, "ann", 7.5, "FAILED", "WRONG_PIN"), row(2, "ann", 7.5, "FAILED", "WRONG_PIN", second=20),
        row(3, "ann", 7.5, "APPROVED", second=40), row(4, "ann", 7.5, "PENDING", second=50), row(5, "bob", 1.0, "APPROVED")])
    got = trailing(features.tx_counts(tx), "ann")
    assert (got.total_tx, got.approved_tx, got.failed_tx) == (4, 1, 2)


def test_amounts_of_approved_only(spark):
    tx = tx_rows(spark, [
        row(1, "cy", 12.0, "APPROVED"), row(2, "cy", 18.0, "APPROVED", second=5), row(3, "cy", 33.0, "APPROVED", second=6),
        row(4, "cy", 900.0, "DECLINED", second=7), row(5, "dee", 4.0, "PENDING")])
    stats = features.amount_stats(tx)
    got = trailing(stats, "cy")
    assert (got.avg_amount, got.max_amount, got.min_amount, got.sum_amount) == (21.0, 33.0, 12.0, 63.0)
    assert got.stddev_amount == pytest.approx(117 ** 0.5, rel=1e-9)
    assert stats.where("user_id = 'dee'").isEmpty()


def test_deviation_of_one_amount_is_null(spark):
    got = trailing(features.amount_stats(tx_rows(spark, [row(1, "u", 100.0, "APPROVED")])), "u")
    assert (got.avg_amount, got.stddev_amount) == (100.0, None)


def test_country_mismatch(spark):
    tx = tx_rows(spark, [
        row(1, "u1", 1.0, "APPROVED", country="NG"), row(2, "u2", 1.0, "APPROVED", country="FR"),
        row(3, "u3", 1.0, "APPROVED", country="FR"), row(4, "u4", 1.0, "APPROVED", country=None)])
    profiles = spark.createDataFrame(
        [("u1", "US"), ("u2", "FR"), ("u4", "FR")], "user_id string, home_country string")
    got = {r.transaction_id: (r.mismatch, r.risk_score, r.is_unusual)
           for r in features.country_mismatch(tx, profiles).collect()}
    assert got == {"tx1": (True, 0.8, True), "tx2": (False, 0.0, False),
                   "tx3": (False, 0.0, False), "tx4": (False, 0.0, False)}


def test_velocity_counts_end_together(spark):
    tx = tx_rows(spark, [row(i, "u", 1.0, "APPROVED", second=s) for i, s in enumerate((0, 1500, 1700, 1790, 1795))])
    got = trailing(features.velocity(tx), "u")
    assert (got.cnt_1m, got.cnt_5m, got.cnt_1h) == (2, 4, 5)
    assert got.window_end.timestamp() - at(0).timestamp() == 1800


@pytest.mark.parametrize("devices", [1, 2, 4, 6])
@pytest.mark.parametrize("listed", [False, True])
def test_devices(spark, devices, listed):
    tx = tx_rows(spark, [row(i, "u", 1.0, "APPROVED", device=f"d{i}") for i in range(devices)]
                 + [row(90, "u", 1.0, "APPROVED", device="d0", second=9), row(91, "u", 1.0, "APPROVED", device=None),
                    row(92, "none", 1.0, "APPROVED", device=None)])
    changes = features.device_change(tx, known_devices=listed)
    got = trailing(changes, "u")
    score = {1: 0.0, 2: 0.3, 4: 0.8, 6: 0.9}[devices]
    assert (got.distinct_devices, got.device_change_flag, got.device_score) == (devices, devices > 1, score)
    if listed:
        assert got.known_devices == [f"d{i}" for i in range(devices)]
    assert changes.where("user_id = 'none'").isEmpty()


@pytest.mark.parametrize("failed, small, stuffing, testing", [
    (10, 0, False, False), (11, 0, True, False), (3, 3, False, False), (4, 4, False, True), (12, 12, True, True)])
def test_failure_thresholds(spark, failed, small, stuffing, testing):
    tx = tx_rows(spark, [
        row(i, "u3", 4.99 if i < small else 5.0, "FAILED", "WRONG_PIN") for i in range(failed)
    ] + [row(80, "u3", None, "FAILED", None), row(81, "u3", 1.0, "DECLINED", "INSUFFICIENT_FUNDS"),
         row(82, "u3", 1.0, None, "CARD_BLOCKED")])
    got = trailing(features.failed_attempts(tx.where(f"transaction_id <> 'tx80' or {failed} = 3")), "u3")
    assert got.failed_count == failed + (failed == 3)
    assert got.small_amount_fails == small
    assert (got.declined_count, got.insufficient_funds, got.card_blocked) == (1, 1, 1)
    assert (got.credential_stuffing, got.card_testing, got.hard_block) == (stuffing, testing, stuffing or testing)


def test_tumbling_velocity_keeps_the_earliest(spark):
    tx = tx_rows(spark, [row(2, "u", 2.0, "FAILED", second=5), row(1, "u", 1.0, "APPROVED", second=5),
                         row(3, "u", 3.0, "APPROVED", second=59.999999), row(4, "u", 4.0, "APPROVED", second=60)])
    got = {r.transaction_id: (r["count"], r.amount, r.status) for r in features.tumbling_velocity(tx).collect()}
    assert got == {"tx1": (3, 1.0, "APPROVED"), "tx4": (1, 4.0, "APPROVED")}


def test_nulls_never_count(spark):
    got = trailing(features.tx_counts(tx_rows(spark, [row(1, "u", None, None), row(2, "u", 1.0, "FAILED", second=None)])), "u")
    assert (got.total_tx, got.approved_tx, got.failed_tx) == (1, 0, 0)
