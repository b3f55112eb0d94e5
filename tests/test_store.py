"""Online and offline tables: recency, TTL edges, replay, compaction, lookups."""

import pytest
from pyspark.sql import functions as F

from cardpulse.operators import bucketed, store
from cardpulse.operators.commits import commit_batch, committed_batches, unbroken
from cardpulse.plans.scored import scoring_features
from cardpulse.schema import ONLINE_VIEWS, TRANSACTION_FEATURES, USER_FEATURES
from conftest import at

VIEW = ONLINE_VIEWS["tx_5min"]
LAYOUT = ("user_id string, window_start timestamp, window_end timestamp, total_tx bigint, approved_tx bigint, "
          "failed_tx bigint, last_event_time timestamp")


def counts(spark, rows):
    """rows: (user, end, total, newest event), times in seconds after noon."""
    return spark.createDataFrame([(u, at(e - 300), at(e), n, n, 0, at(t)) for u, e, n, t in rows], LAYOUT)


def online(spark, path, as_of=30):
    return {r.user_id: r.total_tx for r in store.read_online(spark, VIEW, path, at(as_of)).collect()}


def test_the_trailing_window_is_the_value(spark, tmp_path):
    store.write_online(counts(spark, [("u", 180, 5, 59), ("u", 60, 3, 59), ("u", 120, 4, 59), ("u", 0, 9, -1)]),
                       VIEW, str(tmp_path / "t"), 0, at(0))
    assert online(spark, str(tmp_path / "t")) == {"u": 3}


def test_batches_merge_and_a_late_event_updates(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_online(counts(spark, [("u", 60, 3, 59), ("v", 60, 1, 10)]), VIEW, path, 0, at(0))
    store.write_online(counts(spark, [("u", 60, 4, 59)]), VIEW, path, 1, at(10))       # late row, same window
    store.write_online(counts(spark, [("v", 0, 8, -5)]), VIEW, path, 2, at(20))        # older window
    assert online(spark, path) == {"u": 4, "v": 1}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, n in ((0, 3), (1, 4), (1, 4), (0, 3)):
        store.write_online(counts(spark, [("u", 60, n, 59)]), VIEW, path, batch, at(0))
    assert online(spark, path) == {"u": 4}
    assert spark.read.parquet(path).count() == 2


def test_a_batch_in_one_file(spark, tmp_path):
    path = tmp_path / "t"
    store.write_online(counts(spark, [(f"u{i}", 60, i, 59) for i in range(50)]), VIEW, str(path), 0, at(0), files=1)
    assert len(list(path.glob("batch_id=0/*.parquet"))) == 1
    assert online(spark, str(path)) == {f"u{i}": i for i in range(50)}


@pytest.mark.parametrize("as_of, live", [(599, True), (599.999999, True), (600, False), (601, False)])
def test_ttl_ends_exactly(spark, tmp_path, as_of, live):
    path = str(tmp_path / "t")
    store.write_online(counts(spark, [("u", 60, 3, 59)]), VIEW, path, 0, at(0))
    assert online(spark, path, as_of) == ({"u": 3} if live else {})


def test_a_rewrite_restarts_the_ttl(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_online(counts(spark, [("u", 60, 3, 59)]), VIEW, path, 0, at(0))
    store.write_online(counts(spark, [("u", 60, 3, 59)]), VIEW, path, 1, at(500))
    assert online(spark, path, 1099) == {"u": 3}
    assert online(spark, path, 1100) == {}


def test_compaction_keeps_the_values_and_newer_batches_follow(spark, tmp_path):
    path, base, newer = (str(tmp_path / n) for n in ("t", "base", "newer"))
    for batch in range(4):
        store.write_online(counts(spark, [("u", 60 * batch, batch, 60 * batch - 1), (f"v{batch}", 60, 1, 59)]),
                           VIEW, path, batch, at(0))
    before = online(spark, path)
    folded = store.compact_online(spark, VIEW, path, base, at(30))
    assert folded == 3 and online(spark, base) == before
    store.write_online(counts(spark, [("u", 150, 7, 149)]), VIEW, path, 4, at(0))
    store.write_online(counts(spark, [("u", 240, 8, 239)]), VIEW, path, 5, at(-700))
    later = store.read_online(spark, VIEW, [base, path], at(30), folded)
    assert {r.user_id for r in later.collect()} == {"v0", "v1", "v2", "v3"}  # u's newest value has expired
    assert [(r.batch_id, r.reason) for r in store.expired_batches(spark, path, at(30), folded).orderBy("batch_id").collect()
            ] == [(0, "folded"), (1, "folded"), (2, "folded"), (3, "folded"), (5, "expired")]
    assert spark.read.parquet(base).count() == len(before) == 5
    store.write_online(counts(spark, [("u", 180, 9, 179)]), VIEW, newer, 0, at(20))
    assert online(spark, [base, newer]) == {**before, "u": 9}
    with pytest.raises(ValueError):
        store.compact_online(spark, VIEW, path, path)


def test_compaction_drops_the_expired(spark, tmp_path):
    path, base = str(tmp_path / "t"), str(tmp_path / "base")
    store.write_online(counts(spark, [("u", 60, 3, 59)]), VIEW, path, 0, at(0))
    store.write_online(counts(spark, [("v", 60, 3, 59)]), VIEW, path, 1, at(300))
    store.compact_online(spark, VIEW, path, base, at(600))
    assert online(spark, base, 600) == {"v": 3}


def tx_features(spark, rows):
    return spark.createDataFrame(
        [(t, u, at(s), m, r, r >= 0.8) for t, u, s, m, r in rows],
        "transaction_id string, user_id string, event_timestamp timestamp, country_mismatch_flag boolean, "
        "country_risk_score double, is_unusual_country boolean")


def test_push_fills_both_stores_and_replays(spark, tmp_path):
    on, off = str(tmp_path / "on"), str(tmp_path / "off")
    first = tx_features(spark, [("t1", "u", 0, True, 0.4), ("t2", "u", 86400, True, 0.8)])
    for _ in range(2):
        store.push_features(first, TRANSACTION_FEATURES, on, off, 0, at(0))
    store.push_features(tx_features(spark, [("t1", "u", 0, False, 0.0)]), TRANSACTION_FEATURES, on, off, 1, at(5))
    history = store.read_offline(spark, TRANSACTION_FEATURES, off)
    assert {r.transaction_id: r.country_risk_score for r in history.collect()} == {"t1": 0.0, "t2": 0.8}
    assert {str(r.event_date) for r in history.collect()} == {"2024-05-01", "2024-05-02"}
    live = store.read_online(spark, TRANSACTION_FEATURES, on, at(10))
    assert {r.transaction_id: r.country_risk_score for r in live.collect()} == {"t1": 0.0, "t2": 0.8}


def test_lookup_of_nine_features(spark, tmp_path):
    users = spark.createDataFrame(
        [("u", at(60), 3, 2, 1, 10.0, None, 0.5, 2, True, 1, False, at(59))],
        "user_id string, event_timestamp timestamp, " + ", ".join(f"{n} {t}" for n, t in USER_FEATURES.columns)
        + ", last_event_time timestamp")
    live_users = store.online_rows(users, USER_FEATURES, at(60))
    live_tx = store.online_rows(tx_features(spark, [("t1", "u", 0, True, 0.4)]), TRANSACTION_FEATURES, at(0))
    requests = spark.createDataFrame([("u", "t1"), ("u", "t2"), ("ghost", "t1")], "user_id string, transaction_id string")
    got = {(r.user_id, r.transaction_id): tuple(r)[2:] for r in scoring_features(requests, live_users, live_tx).select(
        "user_id", "transaction_id", "tx_last_5min_total", "tx_last_5min_failed", "avg_amount_24h", "velocity_score",
        "device_change_flag", "failed_attempts_30min", "hard_block", "country_mismatch_flag",
        "country_risk_score").collect()}
    user = (3, 1, 10.0, 0.5, True, 1, False)
    assert got == {("u", "t1"): (*user, True, 0.4), ("u", "t2"): (*user, None, None),
                   ("ghost", "t1"): (*(None,) * 7, True, 0.4)}


def test_gets_and_json(spark):
    live = store.online_rows(counts(spark, [("u", 60, 3, 59), ("v", 60, 4, 59)]), VIEW, at(0))
    wanted = spark.createDataFrame([("v",), ("ghost",), ("v",)], "user_id string")
    got = store.multi_get(live, VIEW, wanted).collect()
    assert sorted((r.key, r.value) for r in got if r.value) == [
        ("feature:tx_5min:v", '{"total_tx":4,"approved_tx":4,"failed_tx":0}')] * 2
    assert [r.key for r in got if r.value is None] == ["feature:tx_5min:ghost"]
    back = store.from_json_value(store.multi_get(live, VIEW, wanted), VIEW)
    assert {r.total_tx for r in back.collect()} == {4, None}
    assert tuple(store.get_one(live, VIEW, "u").first()) == ("u", 3, 3, 0)
    assert store.get_one(live, VIEW, "ghost").isEmpty()
    pairs = store.key_values(counts(spark, [("u", 60, 3, 59), ("u", 120, 9, 59)]), VIEW).collect()
    assert [tuple(p) for p in pairs] == [("feature:tx_5min:u", '{"total_tx":3,"approved_tx":3,"failed_tx":0}', 600, "2024-05-01 12:01:00")]


def test_a_point_lookup_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_online(counts(spark, [("u", 60, 3, 59)]), VIEW, path, 0, at(0))
    plan = store.get_one(store.read_online(spark, VIEW, path, at(0)), VIEW, "u")._jdf.queryExecution().toString()
    assert "EqualTo(user_id,u)" in plan


def test_a_crash_between_the_two_writes_shows_neither(spark, tmp_path):
    on, off, commits = (str(tmp_path / n) for n in ("on", "off", "commits"))
    assert committed_batches(spark, commits) == []

    def push(batch, tx, risk):
        store.push_features(tx_features(spark, [(tx, "u", 0, True, risk)]), TRANSACTION_FEATURES, on, off, batch, at(0),
                            commits=commits)

    def shown():
        live = store.read_online(spark, TRANSACTION_FEATURES, on, at(1), commits=commits)
        kept = store.read_offline(spark, TRANSACTION_FEATURES, off, commits=commits)
        return [{r.transaction_id: r.country_risk_score for r in rows.collect()} for rows in (live, kept)]

    push(0, "t0", 0.4)
    second = tx_features(spark, [("t1", "u", 0, True, 0.8)])
    store.write_offline(second, off, 1)
    assert shown() == [{"t0": 0.4}] * 2
    store.write_online(second, TRANSACTION_FEATURES, on, 1, at(0))  # still before the batch is listed
    assert shown() == [{"t0": 0.4}] * 2
    for _ in range(2):
        push(1, "t1", 0.8)
    assert shown() == [{"t0": 0.4, "t1": 0.8}] * 2
    push(1, "t1", 0.0)  # listed batches are left untouched
    assert shown() == [{"t0": 0.4, "t1": 0.8}] * 2
    assert committed_batches(spark, commits) == [0, 1] and committed_batches(spark, commits, 0) == [1]


def test_an_empty_batch_is_listed(spark, tmp_path):
    on, off, commits = (str(tmp_path / n) for n in ("on", "off", "commits"))
    rows = tx_features(spark, [("t0", "u", 0, True, 0.4)])
    for batch, part in enumerate((rows, rows.where("false"))):
        store.push_features(part, TRANSACTION_FEATURES, on, off, batch, at(0), commits=commits)
    assert committed_batches(spark, commits) == [0, 1]
    assert store.read_offline(spark, TRANSACTION_FEATURES, off, commits=commits).count() == 1


def test_compaction_stops_at_a_batch_that_is_not_listed(spark, tmp_path):
    path, base, commits = (str(tmp_path / n) for n in ("t", "base", "commits"))
    for batch in range(4):
        store.write_online(counts(spark, [(f"u{batch}", 60, batch + 1, 59)]), VIEW, path, batch, at(0))
        if batch != 2:
            commit_batch(spark, commits, batch)
    folded = store.compact_online(spark, VIEW, path, base, at(30), commits=commits)
    assert folded == 1 and online(spark, base) == {"u0": 1, "u1": 2}
    commit_batch(spark, commits, 2)
    live = store.read_online(spark, VIEW, [base, path], at(30), folded, commits)
    assert {r.user_id: r.total_tx for r in live.collect()} == {f"u{i}": i + 1 for i in range(4)}
    assert (unbroken([]), unbroken([0, 1, 3]), unbroken([3, 4], 2), unbroken([4], 2)) == (-1, 1, 4, 2)


def test_a_bucketed_table_is_not_shuffled(spark, tmp_path):
    rows = counts(spark, [(f"u{i}", 60, i, 59) for i in range(50)])
    bucketed.create_bucketed(spark, VIEW, "bucketed_tx", rows, str(tmp_path / "t"), 8)
    for batch, part in ((0, rows), (1, counts(spark, [("u1", 120, 7, 119)])), (1, counts(spark, [("u1", 120, 8, 119)]))):
        bucketed.write_bucketed(part, VIEW, "bucketed_tx", batch, at(0))
    assert len(list((tmp_path / "t").glob("batch_id=0/*.parquet"))) <= 8  # one file per bucket
    live = bucketed.read_bucketed(spark, VIEW, "bucketed_tx", at(30))
    assert {r.user_id: r.total_tx for r in live.collect()} == {f"u{i}": i for i in range(50)} | {"u1": 8}
    assert bucketed.read_bucketed(spark, VIEW, "bucketed_tx", at(600)).isEmpty()
    requests = spark.range(1000).selectExpr("concat('u', id % 60) as user_id", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the table were large
    try:
        found = store.get_online_features(requests, [(VIEW, live, None)])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in plan[plan.index("FileScan"):]
        assert "Exchange" not in live._jdf.queryExecution().executedPlan().toString()
        assert found.where("total_tx is not null").count() == sum(1 for i in range(1000) if i % 60 < 50)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("drop table bucketed_tx")
