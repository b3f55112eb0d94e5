"""Point-in-time joins against brute force, at the TTL's edges, and with hot entities."""

import random

import pytest
from pyspark.sql import functions as F

from cardpulse.operators import skew
from cardpulse.operators.pointintime import Lookup, point_in_time_join
from cardpulse.plans import tables
from cardpulse.schema import FeatureView
from conftest import at, tx_rows

FAST = FeatureView("fast", ("user_id",), 600, (("a", "bigint"),))
SLOW = FeatureView("slow", ("user_id",), 86400, (("b", "double"), ("c", "string")))
OWN = FeatureView("own", ("transaction_id",), 60, (("d", "boolean"),))

SPINE = "user_id string, transaction_id string, event_timestamp timestamp"


def features(spark, view, rows):
    layout = ", ".join(f"{n} string" for n in view.entity) + ", event_timestamp timestamp, " + ", ".join(
        f"{n} {t}" for n, t in view.columns)
    return spark.createDataFrame(rows, layout)


def brute(spine, facts, view):
    """Per spine row the newest live feature row's values, by plain search."""
    out = {}
    ttl = view.ttl_seconds
    for user, tx, t in spine:
        entity = user if view.entity == ("user_id",) else tx
        best = None
        for e, ft, *values in facts:
            if e is not None and e == entity and t is not None and ft <= t and (t - ft).total_seconds() <= ttl:
                if best is None or ft > best[0]:
                    best = (ft, values)
        out[tx] = tuple(best[1]) if best else (None,) * len(view.columns)
    return out


@pytest.mark.parametrize("spread", [1, 8, 50])
def test_against_brute_force(spark, spread):
    rng = random.Random(3)
    users = ["hot"] * 4 + [f"u{i}" for i in range(6)] + [None]
    spine = [(rng.choice(users), f"t{i}", at(rng.uniform(-200_000, 200_000)) if i % 40 else None) for i in range(400)]
    def history(n, values):
        seen = {}
        for _ in range(n):
            seen[rng.choice(users), at(rng.uniform(-300_000, 200_000))] = values()
        return [(u, t, *v) for (u, t), v in seen.items()]
    # features of the fast view close to spine times, so that its short TTL matters
    fast = [(u, at((t - at(0)).total_seconds() - rng.choice([0, 1, 599.5, 600, 600.5])), rng.randrange(9))
            for u, _, t in spine if t is not None]
    fast = list({(u, t): (u, t, v) for u, t, v in fast}.values())
    slow = history(150, lambda: (rng.choice([None, 1.5, 2.5]), rng.choice([None, "x"])))
    own = [(f"t{i}", at(rng.uniform(-100, 100)) if t is None else t, bool(i % 2)) for i, (_, _, t) in enumerate(spine)]

    got = point_in_time_join(
        spark.createDataFrame(spine, SPINE),
        [Lookup(features(spark, FAST, fast), FAST), Lookup(features(spark, SLOW, slow), SLOW, ("c", "b")),
         Lookup(features(spark, OWN, own), OWN)],
        spine_key=("transaction_id",), spread=spread)
    assert got.columns == ["user_id", "transaction_id", "event_timestamp", "a", "c", "b", "d"]
    rows = {r.transaction_id: r for r in got.collect()}
    assert len(rows) == got.count() == 400
    expected = [brute(spine, facts, view) for facts, view in ((fast, FAST), (slow, SLOW), (own, OWN))]
    for tx, r in rows.items():
        assert (r.a,) == expected[0][tx]
        assert (r.b, r.c) == expected[1][tx]
        assert (r.d,) == expected[2][tx]
    assert sum(r.a is not None for r in rows.values()) > 100


@pytest.mark.parametrize("age, found", [(0, True), (-0.000001, False), (600, True), (600.000001, False)])
def test_edges_of_the_ttl(spark, age, found):
    spine = spark.createDataFrame([("u", "t", at(0))], SPINE)
    facts = features(spark, FAST, [("u", at(-age), 7)])
    assert point_in_time_join(spine, [Lookup(facts, FAST)]).first().a == (7 if found else None)


def test_a_newer_null_hides_an_older_value(spark):
    spine = spark.createDataFrame([("u", "t", at(0))], SPINE)
    facts = features(spark, SLOW, [("u", at(-20), 1.0, "old"), ("u", at(-10), None, "new")])
    got = point_in_time_join(spine, [Lookup(facts, SLOW)]).first()
    assert (got.b, got.c) == (None, "new")


def test_no_features_at_all(spark):
    spine = spark.createDataFrame([("u", "t", at(0))], SPINE)
    assert point_in_time_join(spine, [Lookup(features(spark, FAST, []), FAST)]).first().a is None


def test_a_hot_slot_is_split_and_stays_whole(spark):
    """A third of the spine belongs to one user and one slot; with shares it spreads over many tasks."""
    spine = spark.range(60_000).selectExpr(
        "case when id % 3 = 0 then 'hot' else 'u' || id % 500 end as user_id", "'t' || id as transaction_id",
        "timestamp_seconds(1700000000 + id % 1000) as event_timestamp")
    facts = spark.range(0, 1000, 50).selectExpr("timestamp_seconds(1700000000 + id) as event_timestamp", "id as a") \
        .crossJoin(spark.sql("select 'hot' as user_id union all select 'u1'"))
    joined = {n: point_in_time_join(spine, [Lookup(facts, FAST)], spread=n) for n in (1, 20)}
    assert joined[20].count() == 60_000
    assert joined[1].exceptAll(joined[20]).isEmpty()
    busiest = joined[20].where("user_id = 'hot'").groupBy(F.spark_partition_id()).count().count()
    assert busiest > 1


def test_only_busy_slots_are_copied(spark):
    """Of 100 users one has more rows than fit a task; only that one's features are copied to the shares."""
    spine = spark.range(12_000).selectExpr(
        "case when id < 9000 then 'hot' when id % 7 = 0 then null else 'u' || id % 99 end as user_id",
        "'t' || id as transaction_id", "timestamp_seconds(1700000000 + id % 500) as event_timestamp")
    facts = spark.sql("select 'u' || id as user_id from range(99) union all select 'hot'").crossJoin(
        spark.range(0, 500, 50).selectExpr("timestamp_seconds(1700000000 + id) as event_timestamp", "id as a"))
    rows, keys = spine.withColumn("_slot", F.lit(0)), ["user_id", "_slot"]
    busy = skew.busy_keys(rows, keys)
    assert [tuple(r) for r in busy.collect()] == [("hot", 0)]
    dealt, copied = skew.spread_keys(
        rows, facts.withColumn("_slot", F.lit(0)), keys, F.xxhash64("transaction_id"), 8, busy)
    assert copied.count() == 99 * 10 + 8 * 10
    shares = {r.user_id: r.n for r in dealt.groupBy("user_id").agg(F.countDistinct("_share").alias("n")).collect()}
    assert shares["hot"] == 8 and shares[None] > 8
    assert {n for user, n in shares.items() if user not in ("hot", None)} == {1}
    joined = {n: point_in_time_join(spine, [Lookup(facts, FAST)], spread=n) for n in (1, 8)}
    assert joined[8].count() == 12_000
    assert joined[1].exceptAll(joined[8]).isEmpty() and joined[8].exceptAll(joined[1]).isEmpty()


@pytest.mark.parametrize("full", [0, 5])
def test_dealt_slots_against_brute_force(spark, monkeypatch, full):
    monkeypatch.setattr(skew.busy_keys, "__defaults__", (full,))
    test_against_brute_force(spark, 8)


def test_wide_row_renames_and_keeps_absent_features_null(spark):
    from cardpulse.operators import features as f

    tx = tx_rows(spark, [("a", "u1", 50.0, "FAILED", None, "FR", None, 0.0),
                         ("b", "u2", 10.0, "APPROVED", None, "FR", "d1", 0.0)])
    wide = tables.build_user_features(
        f.tx_counts(tx), f.amount_stats(tx, "1 hour", "1 minute"), f.velocity(tx),
        f.device_change(tx, "1 hour", "1 minute"), f.failed_attempts(tx))
    first = {r.user_id: r for r in wide.where(F.col("event_timestamp") == F.lit(at(60))).collect()}
    assert first["u1"].tx_last_5min_failed == 1 and first["u1"].avg_amount_24h is None
    assert first["u1"].distinct_devices_24h is None and first["u1"].device_change_flag is None
    assert (first["u2"].avg_amount_24h, first["u2"].distinct_devices_24h) == (10.0, 1)
    assert first["u2"].failed_attempts_30min is None  # the 30-minute grid has no window end yet
    later = {r.user_id: r for r in wide.where(F.col("event_timestamp") == F.lit(at(300))).collect()}
    assert (later["u1"].failed_attempts_30min, later["u1"].hard_block) == (1, False)
