import math

import pytest
from pyspark.sql import functions as F

from cardpulse.functions import scalars
from cardpulse.functions.times import micros, slot_of


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("counts", [(0, 0, 0), (20, 30, 50), (1, 2, 3), (3, 8, 20), (800, 800, 800)])
def test_velocity(spark, counts):
    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    expected = round(0.5 * sigmoid(counts[0] - 3) + 0.3 * sigmoid(counts[1] - 8) + 0.2 * sigmoid(counts[2] - 20), 4)
    assert one(spark, scalars.velocity(*map(F.lit, counts))) == expected


def test_velocity_known_values(spark):
    assert one(spark, scalars.velocity(F.lit(0), F.lit(0), F.lit(0))) == 0.0238
    assert one(spark, scalars.velocity(F.lit(20), F.lit(30), F.lit(50))) == 1.0


def test_sigmoid_is_finite(spark):
    assert one(spark, scalars.sigmoid(F.lit(-800.0))) == 0.0
    assert one(spark, scalars.sigmoid(F.lit(800.0))) == 1.0


@pytest.mark.parametrize("merchant, home, expected", [
    (None, "FR", (False, 0.0, False)),
    ("FR", None, (False, 0.0, False)),
    (None, None, (False, 0.0, False)),
    ("", "FR", (False, 0.0, False)),
    ("FR", "", (False, 0.0, False)),
    ("FR", "FR", (False, 0.0, False)),
    ("FR", "DE", (True, 0.4, False)),
    ("NG", "US", (True, 0.8, True)),
    ("RO", "GB", (True, 0.8, True)),
    ("CN", "DE", (True, 0.8, True)),
    ("US", "NG", (True, 0.4, False)),
    ("GB", "RO", (True, 0.4, False)),
    ("DE", "CN", (True, 0.4, False)),
])
def test_country_risk(spark, merchant, home, expected):
    text = lambda v: F.lit(v).cast("string")
    assert tuple(one(spark, scalars.country_risk(text(merchant), text(home)))) == expected


@pytest.mark.parametrize("devices, expected", [
    (0, 0.0), (1, 0.0), (2, 0.3), (3, 0.6), (4, 0.8), (5, 0.9), (6, 0.9), (40, 0.9)])
def test_device_score(spark, devices, expected):
    assert one(spark, scalars.device_score(F.lit(devices))) == expected


@pytest.mark.parametrize("average, amount, expected", [
    (None, 10.0, 1.0), (0.0, 10.0, 1.0), (-1.0, 10.0, 1.0), (3.0, 10.0, 3.3333), (20.0, 10.0, 0.5)])
def test_amount_ratio(spark, average, amount, expected):
    assert one(spark, scalars.amount_ratio(F.lit(average).cast("double"), F.lit(amount))) == expected


def test_keys_json_and_ttls(spark):
    row = spark.range(1).select(
        scalars.feature_key("velocity", F.lit("u1")).alias("key"),
        scalars.time_text(F.lit("2024-05-01 12:00:00").cast("timestamp")).alias("text"),
        *[scalars.ttl_of(F.lit(n)).alias(n) for n in
          ("tx_5min", "avg_amount_24h", "country_mismatch", "velocity", "device_change", "failed_attempts", "else")],
    ).first()
    assert row.key == "feature:velocity:u1"
    assert row.text == "2024-05-01 12:00:00"
    assert tuple(row)[2:] == (600, 86400, 300, 300, 86400, 1800, 600)
    text = spark.sql("select 1 as a, cast(null as string) as b").select(scalars.feature_json("a", "b")).first()[0]
    assert text == '{"a":1,"b":null}'


def test_durations(spark):
    assert micros("5 minutes") == 300_000_000
    assert micros("1 hour 30 minutes") == 5_400_000_000
    for wrong in ("", "minutes", "5 parsecs", "0 minutes"):
        with pytest.raises(ValueError):
            micros(wrong)


def test_slots_are_exact_before_the_epoch(spark):
    for us, slot in ((0, 0), (59_999_999, 0), (60_000_000, 1), (-1, -1), (-60_000_000, -1), (-60_000_001, -2)):
        assert one(spark, slot_of(F.lit(us).cast("bigint"), 60_000_000)) == slot
