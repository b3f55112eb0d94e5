"""The window operators against brute force over random transactions, and their behaviour on edges and skew."""

import random
import statistics
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cardpulse.functions.times import micros
from cardpulse.operators import features
from cardpulse.operators.windows import Tally, sliding_amounts, sliding_distinct, sliding_members, sliding_tallies
from conftest import at, tx_rows

SHAPES = [("5 minutes", "1 minute"), ("30 minutes", "5 minutes"), ("1 minute", "1 minute"),
          ("7 minutes", "3 minutes"), ("1 hour", "25 minutes")]


def random_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = rng.choice(["u1", "u1", "u1", "u2", "u3", "u4"])
        second = rng.choice([rng.uniform(-9000, 9000), rng.randrange(-150, 150) * 60, None if i % 50 == 0 else 0.000001])
        rows.append((
            f"t{i}", user, rng.choice([None, 4.99, 5.0, 19.9, round(rng.uniform(0, 500), 2)]),
            rng.choice(["APPROVED", "APPROVED", "FAILED", "DECLINED", None]),
            rng.choice([None, "CARD_BLOCKED", "INSUFFICIENT_FUNDS", "WRONG_PIN"]), "FR",
            rng.choice([None, "d1", "d2", "d3", "d4"]), second))
    return rows


def brute_windows(rows, length, slide, keep=lambda row: True):
    """{(user, end_us): rows} over all windows; starts are multiples of the slide."""
    length, slide = micros(length), micros(slide)
    epoch = at(0) - timedelta(seconds=at(0).timestamp())
    out = defaultdict(list)
    for row in rows:
        if row[7] is None or not keep(row):
            continue
        us = (at(row[7]) - epoch) // timedelta(microseconds=1)
        start = us // slide * slide
        while start > us - length:
            out[row[1], start + length].append((us, row))
            start -= slide
    return out


def by_window(df, *columns):
    rows = df.select("user_id", F.unix_micros("window_end").alias("end"), F.unix_micros("window_start").alias("start"),
                     F.unix_micros("last_event_time").alias("last"), *columns).collect()
    out = {(r.user_id, r.end): tuple(r)[2:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def rows():
    return random_rows(7)


@pytest.fixture(scope="module")
def tx(spark, rows):
    return tx_rows(spark, rows).cache()


@pytest.mark.parametrize("length, slide", SHAPES)
def test_tallies(tx, rows, length, slide):
    got = by_window(sliding_tallies(tx, [
        Tally("n", length), Tally("failed", length, "status = 'FAILED'"),
        Tally("recent", "1 minute", "status = 'FAILED'"),
    ], slide), "n", "failed", "recent")
    expected = {}
    for (user, end), members in brute_windows(rows, length, slide).items():
        failed = [us for us, r in members if r[3] == "FAILED"]
        expected[user, end] = (
            end - micros(length), max(us for us, _ in members), len(members), len(failed),
            sum(us >= end - 60_000_000 for us in failed))
    assert got == expected


@pytest.mark.parametrize("length, slide", SHAPES)
def test_amounts(tx, rows, length, slide):
    got = by_window(sliding_amounts(tx, length, slide),
                    "avg_amount", "stddev_amount", "max_amount", "min_amount", "sum_amount")
    brute = brute_windows(rows, length, slide)
    assert got.keys() == brute.keys()
    for key, members in brute.items():
        amounts = [r[2] for _, r in members if r[2] is not None]
        _, last, mean, deviation, top, low, total = got[key]
        assert last == max(us for us, _ in members)
        if not amounts:
            assert (mean, deviation, top, low, total) == (None,) * 5
            continue
        assert (top, low) == (max(amounts), min(amounts))
        assert mean == pytest.approx(statistics.fmean(amounts), rel=1e-12)
        assert total == pytest.approx(sum(amounts), rel=1e-12)
        if len(amounts) < 2:
            assert deviation is None
        else:
            assert deviation == pytest.approx(statistics.stdev(amounts), rel=1e-9, abs=1e-9)


def test_deviation_of_large_equal_amounts_is_zero(spark):
    tx = tx_rows(spark, [(f"t{i}", "u1", 123456789.01, "APPROVED", None, "FR", "d", 100 * i) for i in range(40)])
    worst = sliding_amounts(tx, "1 hour", "5 minutes").agg(F.max("stddev_amount")).first()[0]
    assert worst < 1e-6


@pytest.mark.parametrize("length, slide", SHAPES)
def test_distinct_and_members(tx, rows, length, slide):
    brute = brute_windows(rows, length, slide, keep=lambda r: r[6] is not None)
    expected = {key: {r[6] for _, r in members} for key, members in brute.items()}
    counts = by_window(sliding_distinct(tx, "device_id", length, slide, "n"), "n")
    assert {k: v[2] for k, v in counts.items()} == {k: len(v) for k, v in expected.items()}
    assert {k: v[1] for k, v in counts.items()} == {k: max(us for us, _ in m) for k, m in brute.items()}
    members = sliding_members(tx, "device_id", length, slide).select(
        "user_id", F.unix_micros("window_end").alias("end"), "device_id").collect()
    assert len(members) == len({tuple(m) for m in members})
    found = defaultdict(set)
    for m in members:
        found[m.user_id, m.end].add(m.device_id)
    assert dict(found) == expected


def test_window_edges_are_half_open(spark):
    tx = tx_rows(spark, [("a", "u", 1.0, "APPROVED", None, "FR", "d", 0), ("b", "u", 1.0, "APPROVED", None, "FR", "d", 300)])
    counts = {r.end: r.total_tx for r in features.tx_counts(tx).select(
        (F.unix_seconds("window_end") - int(at(0).timestamp())).alias("end"), "total_tx").collect()}
    assert counts == {60: 1, 120: 1, 180: 1, 240: 1, 300: 1, 360: 1, 420: 1, 480: 1, 540: 1, 600: 1}


def test_idle_years_cost_nothing(spark):
    """A user silent for decades between two events gets the windows of the two events only."""
    tx = tx_rows(spark, [("a", "u", 1.0, "APPROVED", None, "FR", "d", 0),
                         ("b", "u", 1.0, "APPROVED", None, "FR", "d", -1_500_000_000)])
    assert features.tx_counts(tx).count() == 10
    assert features.velocity(tx).count() == 120


def test_slide_longer_than_window_is_refused(tx):
    with pytest.raises(ValueError):
        features.tx_counts(tx, "1 minute", "5 minutes")


def test_hot_user_holds_a_third_of_all_rows(spark):
    """One user with a third of 300,000 rows, many on one instant and each with a device of its own."""
    n = 300_000
    tx = spark.range(n, numPartitions=8).selectExpr(
        "'t' || id as transaction_id",
        "case when id % 3 = 0 then 'hot' else 'user-' || (id % 5000) end as user_id",
        "case when id % 2 = 0 then 'FAILED' else 'APPROVED' end as status",
        "cast(null as string) as failure_reason", "cast(id % 100 as double) as amount", "'d' || id as device_id",
        "timestamp_seconds(1700000000 + case when id % 6 = 0 then 0 else id % 7200 end) as event_time",
    )
    direct = tx.groupBy("user_id", F.window("event_time", "5 minutes", "1 minute").alias("w")).agg(
        F.count("*").alias("total_tx"), F.countDistinct("device_id").alias("devices")).select(
        "user_id", F.col("w.end").alias("window_end"), "total_tx", "devices")
    counts = features.tx_counts(tx).select("user_id", "window_end", "total_tx")
    devices = features.device_change(tx, "5 minutes", "1 minute").select(
        "user_id", "window_end", F.col("distinct_devices").alias("devices"))
    both = counts.join(devices, ["user_id", "window_end"], "full")
    assert direct.exceptAll(both).isEmpty() and both.exceptAll(direct).isEmpty()
