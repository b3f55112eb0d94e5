"""Scalar risk functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardpulse.schema import DEFAULT_TTL, ONLINE_TTL, RISKY_PAIRS


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def velocity(count_1m, count_5m, count_1h) -> Column:
    """Weighted burst score in [0, 1] of the counts of one minute, five minutes and one hour."""
    burst = sigmoid(_col(count_1m) - 3)
    pattern = sigmoid(_col(count_5m) - 8)
    takeover = sigmoid(_col(count_1h) - 20)
    return F.round(F.lit(0.5) * burst + F.lit(0.3) * pattern + F.lit(0.2) * takeover, 4)


def country_risk(merchant_country, home_country, risky_pairs=RISKY_PAIRS) -> Column:
    """Struct (mismatch, risk_score, is_unusual). A missing or empty country on either side carries no risk."""
    merchant, home = _col(merchant_country), _col(home_country)
    known = (F.coalesce(merchant, F.lit("")) != "") & (F.coalesce(home, F.lit("")) != "")
    risky = reduce(lambda a, b: a | b, [(merchant == m) & (home == h) for m, h in risky_pairs], F.lit(False))
    mismatch = F.when(known, merchant != home).otherwise(False)
    score = F.when(known & risky, 0.8).when(mismatch, 0.4).otherwise(0.0)
    return F.struct(
        mismatch.alias("mismatch"),
        score.alias("risk_score"),
        (score >= 0.8).alias("is_unusual"),
    )


def device_score(devices) -> Column:
    n = _col(devices)
    return F.when(n == 2, 0.3).when(n == 3, 0.6).when(n == 4, 0.8).when(n >= 5, 0.9).otherwise(0.0)


def amount_ratio(average, amount) -> Column:
    """Amount relative to the average; 1.0 where there is no positive average."""
    average, amount = _col(average), _col(amount)
    return F.when(average > 0, F.round(amount / average, 4)).otherwise(1.0)


def feature_key(name: str, entity) -> Column:
    return F.concat_ws(":", F.lit("feature"), F.lit(name), _col(entity).cast("string"))


def feature_json(*columns: str) -> Column:
    """The columns as one JSON object; absent values are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def ttl_of(name) -> Column:
    """Seconds a feature stays live, by feature name."""
    column, ttl = _col(name), F.lit(DEFAULT_TTL)
    for feature, seconds in ONLINE_TTL.items():
        ttl = F.when(column == feature, seconds).otherwise(ttl)
    return ttl


def time_text(at) -> Column:
    return F.date_format(_col(at), "yyyy-MM-dd HH:mm:ss")
