"""The same operators on streams: equal to the batch, unmoved by late rows and replays."""

import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from cardpulse.operators import conform, features, store, windows
from cardpulse.plans import adapter
from cardpulse.plans.scored import alert_messages, decide_requests
from cardpulse.schema import ONLINE_VIEWS, TRANSACTION_FEATURES, USER_FEATURES
from cardpulse.streaming import panes, scorer
from cardpulse.streaming import queries as streams
from conftest import TX_DDL, at, tx_rows

ONCE = {"availableNow": True}


def file_stream(spark, folder, schema, per_batch=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def add_file(df, folder, order):
    """One file per micro-batch, in the given order (file sources go by modification time)."""
    staging = f"{folder}-staging-{order}"
    df.coalesce(1).write.parquet(staging)
    os.makedirs(folder, exist_ok=True)
    part = next(n for n in os.listdir(staging) if n.endswith(".parquet"))
    target = f"{folder}/{order:04d}.parquet"
    os.link(f"{staging}/{part}", target)
    os.utime(target, (1_700_000_000 + order, 1_700_000_000 + order))


def run(df, tmp_path, name, mode="append"):
    """Run to the end of the input and return what an append sink received."""
    out, query = str(tmp_path / f"{name}-rows"), None
    query = (df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-cp"))
             .trigger(**ONCE).start(out))
    query.awaitTermination()
    return df.sparkSession.read.parquet(out)


def diff(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).count(), b.exceptAll(a).count()


@pytest.fixture(scope="module")
def tx(spark, sf_dir):
    return adapter.transactions(spark, "/root/testdata/sf0.001").drop("metadata").cache()


@pytest.fixture(scope="module")
def source(tx, tmp_path_factory):
    """The transactions as four files in time order."""
    folder = str(tmp_path_factory.mktemp("source") / "tx")
    cut = [adapter.EPOCH_US + m * 60_000_000 for m in (-1, 30, 60, 90, 200)]
    for i in range(4):
        add_file(tx.where(F.col("event_us").between(cut[i], cut[i + 1] - 1)), folder, i)
    return folder


CLOSED = {
    "tx_counts": (features.tx_counts, {}),
    "amount_stats": (features.amount_stats, {"window": "1 hour", "slide": "10 minutes"}),
    "velocity": (features.velocity, {}),
    "device_change": (features.device_change, {"window": "1 hour", "slide": "10 minutes"}),
    "failed_attempts": (features.failed_attempts, {}),
}


@pytest.mark.parametrize("name", CLOSED)
def test_stream_equals_batch_on_closed_windows(spark, tx, source, tmp_path, name):
    compute, options = CLOSED[name]
    streamed = run(compute(conform.with_watermark(file_stream(spark, source, tx.schema)), **options), tmp_path, name)
    newest = tx.agg(F.max("event_time")).first()[0]
    closed = F.col("window_end") <= F.date_trunc("millisecond", F.lit(newest)) - F.expr("interval 10 minutes")
    rounded = ["avg_amount", "stddev_amount", "sum_amount"]

    def comparable(df):
        return df.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in df.columns])

    assert streamed.count() > 0
    assert diff(comparable(streamed), comparable(compute(tx, **options).where(closed))) == (0, 0)


@pytest.mark.parametrize("name", [n for n in CLOSED if n != "failed_attempts"])
def test_stream_rows_are_dealt_out_before_they_are_copied(spark, tx, source, name):
    """The task that reads a file must not fold the windows of all its users: its table grows with the file."""
    compute, options = CLOSED[name]
    stream = compute(conform.with_watermark(file_stream(spark, source, tx.schema)), **options)
    plan = stream._jdf.queryExecution().analyzed().toString()
    dealt, copied = plan.find("RepartitionByExpression [user_id"), plan.find("Expand [")
    assert 0 <= copied < dealt  # a plan is printed from its end to its sources


def test_state_is_kept_in_as_many_parts_as_asked_for(spark, tx, source, tmp_path):
    """A batch larger than the session's partitions are made for gets more tasks; the session keeps its setting."""
    assert [streams.partitions_for(n, spark) for n in (0, 800_000, 1_000_001)] == [8, 8, 11]
    streams.start_feature(
        "f04", conform.with_watermark(file_stream(spark, source, tx.schema, 4)), str(tmp_path / "on"), str(tmp_path / "cp"),
        trigger=ONCE, written_at=at(0), partitions=11).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    parts = [n for n in os.listdir(tmp_path / "cp" / "f04" / "state" / "0") if n.isdigit()]
    assert sorted(map(int, parts)) == list(range(11))


def test_one_busy_user_of_a_stream_is_dealt_to_several_tasks(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 16).selectExpr(
        "'hot' as user_id", "timestamp_seconds(1700000000 + id % 600) as event_time", "id")
    dealt = windows.with_windows(rows, 600_000_000, 60_000_000, "user_id", "event_time")
    assert dealt.count() == 40_000
    assert dealt.select(F.spark_partition_id()).distinct().count() > 1


def test_tumbling_stream(spark, tx, source, tmp_path):
    stream = streams.tumbling_input(file_stream(spark, source, tx.schema))
    streamed = run(features.tumbling_velocity(stream), tmp_path, "f07")
    newest = tx.agg(F.max("event_time")).first()[0]
    closed = F.col("window_end") <= F.date_trunc("millisecond", F.lit(newest)) - F.expr("interval 10 seconds")
    assert diff(streamed, features.tumbling_velocity(tx).where(closed)) == (0, 0)


def test_scored_features_are_computed_once(spark, monkeypatch):
    """Both deliveries of the running scorer take the users' rows from one computation of current rows."""
    from cardpulse.plans import catalog

    written, computed = [], catalog._user_features

    def counting(spark, sf_dir, current_only=False):
        written.append(current_only)
        return computed(spark, sf_dir, current_only).withColumn("_at", F.lit(0)).drop("_at")

    stored = []
    monkeypatch.setattr(catalog, "_user_features", counting)
    write = catalog.store.write_online
    monkeypatch.setattr(catalog.store, "write_online", lambda df, view, *a, **b: (
        stored.append((view.name, "Window" in df._jdf.queryExecution().optimizedPlan().toString())), write(df, view, *a, **b)))
    assert catalog.QUERIES["stream_scoring"](spark, "/root/testdata/sf0.001").count() == 1000
    assert written == [True]
    users = [planned for name, planned in stored if name == USER_FEATURES.name]
    assert users == [False, False]


def test_mismatch_stream(spark, tx, source, tmp_path):
    profiles = streams_profiles(spark)
    streamed = run(features.country_mismatch(file_stream(spark, source, tx.schema), profiles), tmp_path, "f03")
    assert diff(streamed, features.country_mismatch(tx, profiles)) == (0, 0)


def streams_profiles(spark):
    table = adapter.profile_table(spark, "/root/testdata/sf0.001")
    return table.withColumnRenamed("country", "home_country")


@pytest.mark.parametrize("name", sorted(streams.FEATURE_QUERIES))
def test_online_table_of_a_stream_equals_the_batch(spark, tx, source, tmp_path, name):
    """Update mode, four micro-batches: the current value of every entity is the one the batch finds."""
    query = streams.FEATURE_QUERIES[name]
    profiles = streams_profiles(spark)
    stream = conform.with_watermark(file_stream(spark, source, tx.schema))
    online = str(tmp_path / "online")
    streams.start_feature(name, stream, online, str(tmp_path / "cp"), profiles, ONCE, at(0)).awaitTermination()
    batch = query.run(tx, profiles)
    names = [*query.view.entity, *query.view.names]
    exact = [F.round(c, 6).alias(c) if "amount" in c else F.col(c) for c in names]
    live = store.read_online(spark, query.view, online, at(1)).select(exact)
    assert live.count() > 0
    assert diff(live, store.online_rows(batch, query.view, at(0)).select(exact)) == (0, 0)


@pytest.mark.parametrize("name", sorted(panes.PANE_FEATURES))
def test_panes_of_a_stream_equal_the_batch(spark, tx, tmp_path, name):
    """Four micro-batches, the last of them with late rows of all times; amounts far from zero."""
    tx = tx.withColumn("amount", F.col("amount") + 1e7)
    folder, online, kept = str(tmp_path / "tx"), str(tmp_path / "online"), str(tmp_path / "panes")
    late = F.col("k") % 7 == 3
    for order, minutes in enumerate(((-1, 50), (50, 90), (90, 200))):
        low, high = (adapter.EPOCH_US + m * 60_000_000 for m in minutes)
        add_file(tx.where(~late & F.col("event_us").between(low, high - 1)), folder, order)
    add_file(tx.where(late), folder, 3)
    query = panes.start_pane_feature(
        name, file_stream(spark, folder, tx.schema), kept, online, str(tmp_path / "cp"), ONCE, at(0))
    query.awaitTermination()
    assert len(query.recentProgress) >= 4 and not any(p["stateOperators"] for p in query.recentProgress)
    batch = streams.FEATURE_QUERIES[name]
    names = [*batch.view.entity, "window_end", *batch.view.names]
    exact = [F.round(c, 4).alias(c) if "amount" in c else F.col(c) for c in names]
    live = store.read_online(spark, batch.view, online, at(1)).select(exact)
    assert live.count() > 0
    assert diff(live, store.online_rows(batch.run(tx), batch.view, at(0)).select(exact)) == (0, 0)


def test_a_repeated_batch_of_panes_changes_nothing(spark, tmp_path):
    rows = tx_rows(spark, [("a", "u", 5.0, "APPROVED", None, "FR", "d1", 0), ("b", "u", 7.0, "APPROVED", None, "FR", "d2", 60)])
    later = tx_rows(spark, [("c", "u", 9.0, "APPROVED", None, "FR", "d3", 120)])
    for name, feature in (("f02", panes.amounts_feature()), ("f05", panes.devices_feature())):
        where = [str(tmp_path / name / part) for part in ("panes", "online", "devices")]
        for batch_id, batch in ((0, rows), (1, later), (1, later), (0, rows), (2, later.limit(0))):
            panes.update_feature(batch, batch_id, feature, *where, at(0))
        live = store.read_online(spark, feature.view, where[1], at(1))
        assert live.count() == 1
        row = live.first()
        if name == "f02":
            assert (row.avg_amount, row.min_amount, row.max_amount, row.stddev_amount) == (7.0, 5.0, 9.0, 2.0)
        else:
            assert row.distinct_devices == 3
            assert {r.device_id for r in panes.read_members(live, where[2]).collect()} == {"d1", "d2", "d3"}


def test_blocks_hold_every_batch_once():
    kept = panes.PaneStore("/nowhere", panes.devices_feature(), every=3, levels=2)
    for batch_id in range(60):
        blocks = kept.blocks(batch_id)
        held = [n for level, block in blocks for n in range(block * 3 ** level, (block + 1) * 3 ** level)]
        assert held == list(range(batch_id + 1))
        assert sum(level < 2 for level, _ in blocks) <= 4


def test_files_read_do_not_grow_with_the_number_of_batches(spark, tmp_path):
    feature = panes.devices_feature()
    kept = panes.PaneStore(str(tmp_path / "panes"), feature, every=2, levels=2)
    read = []
    for day in range(16):  # one batch a day; windows reach back one day
        batch = tx_rows(spark, [(f"t{day}", "u", 1.0, "APPROVED", None, "FR", f"d{day}", 86_400 * day)])
        new = kept.add(feature.fold(batch.coalesce(1)), day)
        oldest = new.first()["_pane"] - feature.reach
        rows = kept.since(spark, new.schema, day, oldest)
        assert {r.device_id for r in rows.collect()} == {f"d{d}" for d in range(max(0, day - 1), day + 1)}
        scan = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        read.append(int(scan.metrics().apply("numFiles").value()))
    assert 1 <= max(read) <= 3


def test_history_keeps_the_first_delivery_and_replays_alike(spark, tmp_path):
    path, folder = str(tmp_path / "rows"), str(tmp_path / "tx")
    add_file(tx_rows(spark, [one(0, 1), one(0, 1), one(100_000, 2)]), folder, 0)
    add_file(tx_rows(spark, [one(200_000, 3), one(0, 1)]), folder, 1)  # a day later, the first one again
    add_file(tx_rows(spark, []), folder, 2)
    add_file(tx_rows(spark, [one(100_000, 2), one(5, 4)]), folder, 3)
    for checkpoint in ("cp", "again"):  # a second run from the start repeats all batches
        streams.start_history_dedup(
            file_stream(spark, folder, TX_DDL), path, str(tmp_path / checkpoint), ONCE).awaitTermination()
        rows = spark.read.parquet(path).select("transaction_id", "batch_id").collect()
        assert sorted((r.transaction_id, int(r.batch_id)) for r in rows) == [("t1", 0), ("t2", 0), ("t3", 1), ("t4", 3)]


def test_violations_are_counted_as_a_stream_passes(spark, tmp_path):
    folder = str(tmp_path / "tx")
    good = ("a", "u", 1.0, "m", "FR", "FR", "APPROVED", 5)
    for i, rows in enumerate(([good, (None, None, 1.0, "m", "FR", "FR", "ODD", 5)], [("b", "u", None, "m", "FR", "FR", None, 5)])):
        add_file(spark.createDataFrame(rows, "transaction_id string, user_id string, amount double, merchant_id string, "
                                             "merchant_country string, user_country string, status string, event_time bigint"), folder, i)
    tx = file_stream(spark, folder, spark.read.parquet(folder).schema)
    query = conform.observed_stream(conform.with_violations(tx)).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start(str(tmp_path / "rows"))
    query.awaitTermination()
    seen = [p["observedMetrics"]["violations"] for p in query.recentProgress if p["numInputRows"]]
    totals = {rule: sum(s[rule] for s in seen) for rule in ("rows", "missing user_id", "missing amount", "unknown status", "missing status")}
    assert totals == {"rows": 3, "missing user_id": 1, "missing amount": 1, "unknown status": 1, "missing status": 1}
    found = sorted(tuple(r.violations) for r in spark.read.parquet(str(tmp_path / "rows")).collect())
    assert found == [(), ("missing amount", "missing status"), ("missing transaction_id", "missing user_id", "unknown status")]


def test_a_running_scorer_sees_features_written_after_its_start(spark, tmp_path):
    path = str(tmp_path)
    users = f"user_id string, event_timestamp timestamp, {', '.join(f'{n} {t}' for n, t in USER_FEATURES.columns)}, last_event_time timestamp"
    facts = f"transaction_id string, event_timestamp timestamp, {', '.join(f'{n} {t}' for n, t in TRANSACTION_FEATURES.columns)}"

    def user_row(user, blocked, second):
        return (user, at(second), 1, 1, 0, 5.0, 0.0, 0.1, 1, False, 0, blocked, at(second))

    def request(order, rows):
        add_file(spark.createDataFrame([(t, u, at(s)) for t, u, s in rows], "transaction_id string, user_id string, event_time timestamp"),
                 f"{path}/requests", order)

    store.write_online(spark.createDataFrame([user_row("u", False, 0)], users), USER_FEATURES, f"{path}/users", 0, at(0))
    store.write_online(spark.createDataFrame([], facts), TRANSACTION_FEATURES, f"{path}/tx", 0, at(0))
    request(0, [("t1", "u", 10), ("t2", "nobody", 11), ("t3", None, 12)])
    published = []
    query = scorer.start_scorer(
        file_stream(spark, f"{path}/requests", "transaction_id string, user_id string, event_time timestamp"),
        scorer.stored_features(f"{path}/users", f"{path}/tx"), f"{path}/decisions", f"{path}/cp",
        publish=lambda messages, batch_id: published.append((batch_id, sorted((r.topic, bytes(r.key).decode()) for r in messages.collect()))))
    try:
        query.processAllAvailable()
        store.write_online(spark.createDataFrame([user_row("u", True, 20)], users), USER_FEATURES, f"{path}/users", 1, at(20))
        request(1, [("t4", "u", 30)])
        query.processAllAvailable()
        request(2, [("t5", "u", 90_000)])  # a day later the value has expired
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.transaction_id: (r.decision, r.score) for r in spark.read.parquet(f"{path}/decisions").collect()}
    assert got == {"t1": ("CLEARED", 0.0), "t2": ("CLEARED", 0.0), "t3": ("CLEARED", 0.0), "t4": ("BLOCKED", 1.0), "t5": ("CLEARED", 0.0)}
    assert published[1] == (1, [("fraud-alerts", "t4")]) and [n for n, _ in published] == [0, 1, 2]


def one(second, i, user="u"):
    return (f"t{i}", user, 1.0, "APPROVED", None, "FR", "d", second)


def test_late_rows_do_not_change_a_closed_window(spark, tmp_path):
    folder = str(tmp_path / "tx")
    add_file(tx_rows(spark, [one(0, 1), one(30, 2)]), folder, 0)
    add_file(tx_rows(spark, [one(3600, 3)]), folder, 1)          # moves the watermark to minute 50
    add_file(tx_rows(spark, [one(3601, 7, "v")]), folder, 2)     # the batch that closes the windows up to there
    add_file(tx_rows(spark, [one(10, 4), one(3100, 5)]), folder, 3)  # too late; late but within the delay
    add_file(tx_rows(spark, [one(9000, 6)]), folder, 4)
    rows = run(features.tx_counts(conform.with_watermark(file_stream(spark, folder, TX_DDL))), tmp_path, "late")
    counts = {int(r.end - at(0).timestamp()): r.total_tx
              for r in rows.where("user_id = 'u'").select(F.unix_seconds("window_end").alias("end"), "total_tx").collect()}
    assert [counts[s] for s in (60, 120, 180, 240, 300)] == [2] * 5
    assert counts[3120] == 1 and max(counts) == 3900


def test_late_row_updates_the_online_value(spark, tmp_path):
    folder, online = str(tmp_path / "tx"), str(tmp_path / "online")
    add_file(tx_rows(spark, [one(0, 1), one(30, 2)]), folder, 0)
    add_file(tx_rows(spark, [one(10, 3)]), folder, 1)
    add_file(tx_rows(spark, [one(-290, 4)]), folder, 2)
    stream = conform.with_watermark(file_stream(spark, folder, TX_DDL))
    streams.start_feature("f01", stream, online, str(tmp_path / "cp"), trigger=ONCE, written_at=at(0)).awaitTermination()
    value = store.read_online(spark, ONLINE_VIEWS["tx_5min"], online, at(1)).first()
    assert (value.total_tx, value.window_end.timestamp() - at(0).timestamp()) == (3, 60)


def test_redelivered_transactions_count_once(spark, tmp_path):
    folder = str(tmp_path / "tx")
    add_file(tx_rows(spark, [one(0, 1), one(0, 1), one(30, 2)]), folder, 0)
    add_file(tx_rows(spark, [one(0, 1), one(40, 3)]), folder, 1)
    stream = conform.dedupe_transactions(conform.with_watermark(file_stream(spark, folder, TX_DDL)))
    assert sorted(r.transaction_id for r in run(stream, tmp_path, "dedupe").collect()) == ["t1", "t2", "t3"]


def test_push_stream(spark, tx, source, tmp_path):
    paths = [str(tmp_path / n) for n in ("on", "off", "cp")]
    stream = file_stream(spark, source, tx.schema)
    streams.start_transaction_push(stream, streams_profiles(spark), *paths, trigger=ONCE, written_at=at(0)).awaitTermination()
    history = store.read_offline(spark, TRANSACTION_FEATURES, paths[1])
    live = store.read_online(spark, TRANSACTION_FEATURES, paths[0], at(1))
    assert history.count() == live.count() == tx.count()
    batch = features.country_mismatch(tx, streams_profiles(spark)).select(
        "transaction_id", F.col("risk_score").alias("country_risk_score"))
    assert diff(history.select("transaction_id", "country_risk_score"), batch) == (0, 0)


def test_framed_messages_to_online_features(spark, tmp_path):
    """Framed records of four buyers: the whole way from the wire to velocity and failure values. Buyer n sends
    6 (n + 1) records, one a second, on n + 1 devices; of each six, the first two fail for lack of funds.
    """
    start = int(at(0).timestamp() * 1000)

    def message(n, i):
        short = i % 6 < 2
        body = {
            "transaction_id": f"{n}/{i}", "user_id": f"buyer-{n}", "amount": 3.25 * (i + 1), "currency": "SEK",
            "merchant_id": "kiosk", "merchant_country": "SE", "user_country": "SE", "device_id": f"phone-{i % (n + 1)}",
            "status": "FAILED" if short else "APPROVED", "failure_reason": "INSUFFICIENT_FUNDS" if short else None,
            "ip_address": None, "event_time": start + 1000 * i, "metadata": {},
        }
        return b"\x00" + struct.pack(">I", 42) + json.dumps(body).encode()

    folder = str(tmp_path / "frames")
    sent = [(n, i) for n in range(4) for i in range(6 * (n + 1))]
    values = [(message(n, i),) for n, i in sent] + [(b"broken",), (message(2, 7),)]
    add_file(spark.createDataFrame(values, "value binary"), folder, 0)

    for name, view in (("f04", "velocity"), ("f05", "device_change"), ("f06", "failed_attempts")):
        tx = streams.ingest(file_stream(spark, folder, "value binary"), adapter.writer_schemas())
        once = conform.dedupe_transactions(spark.read.parquet(folder).select("value").transform(
            lambda f: streams.ingest(f, adapter.writer_schemas())))
        streams.start_feature(name, tx, str(tmp_path / name), str(tmp_path / "cp"), trigger=ONCE,
                              written_at=at(0)).awaitTermination()
        live = {r.user_id: r for r in store.read_online(
            spark, ONLINE_VIEWS[view], str(tmp_path / name), at(1)).collect()}
        assert set(live) == {f"buyer-{n}" for n in range(4)}
        if name == "f04":
            assert {u: r.cnt_1m for u, r in live.items()} == {
                "buyer-0": 6, "buyer-1": 12, "buyer-2": 19, "buyer-3": 24}
        elif name == "f05":
            assert {u: r.distinct_devices for u, r in live.items()} == {f"buyer-{n}": n + 1 for n in range(4)}
        else:
            assert {u: r.insufficient_funds for u, r in live.items()} == {
                "buyer-0": 2, "buyer-1": 4, "buyer-2": 7, "buyer-3": 8}
        assert once.count() == len(sent)


def test_ingest_keeps_every_message_in_one_of_two_tables(spark, tmp_path):
    folder = str(tmp_path / "frames")
    good = {"transaction_id": "a", "user_id": "u", "amount": 1.0, "merchant_id": "m", "merchant_country": "SE",
            "user_country": "SE", "status": "APPROVED", "event_time": 1_700_000_000_000}

    def framed(body):
        return (b"\x00" + struct.pack(">I", 42) + json.dumps(body).encode(),)

    batches = [[framed(good), (b"?",)], [framed({**good, "transaction_id": "b", "status": "LOST"}), framed([])]]
    for order, values in enumerate(batches):
        add_file(spark.createDataFrame(values, "value binary"), folder, order)
    paths = [str(tmp_path / n) for n in ("good", "rejected", "cp")]
    streams.start_ingest(file_stream(spark, folder, "value binary"), adapter.writer_schemas(), *paths,
                         trigger=ONCE).awaitTermination()
    kept, rejected = spark.read.parquet(paths[0]), spark.read.parquet(paths[1])
    assert [(r.transaction_id, r.currency, r.event_time.timestamp()) for r in kept.collect()] == [("a", "EUR", 1_700_000_000)]
    assert {(r.transaction_id, r.reject_reason) for r in rejected.collect()} == {
        (None, "too short"), ("b", "unknown status"), (None, "unreadable body")}
    assert rejected.where("value is null").isEmpty()


def test_ingest_once_runs_on_a_stream(spark, tmp_path):
    folder = str(tmp_path / "frames")
    add_file(spark.createDataFrame([(b"broken",)], "value binary"), folder, 0)
    tx = streams.ingest_once(file_stream(spark, folder, "value binary"), adapter.writer_schemas())
    assert run(tx.select("transaction_id", "event_time"), tmp_path, "once").count() == 0


def test_debug_sink_and_messages(spark, tx, source, tmp_path):
    stream = streams.tumbling_input(file_stream(spark, source, tx.schema, 10))
    streams.start_tumbling_velocity(stream, str(tmp_path / "cp"), "memory", ONCE, queryName="tumbling").awaitTermination()
    assert spark.table("tumbling").count() > 0
    messages = file_stream(spark, source, tx.schema, 10).selectExpr(
        "'fraud-alerts' as topic", "cast(transaction_id as binary) as key", "cast(user_id as binary) as value")
    streams.start_messages(messages, str(tmp_path / "cp2"), "parquet", ONCE, path=str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == tx.count()


def test_a_stream_of_requests_is_decided_and_routed(spark, tx, source, tmp_path):
    users = spark.createDataFrame([("user-1", 3, 1, 9.0, 0.2, True, 1, True)], (
        "user_id string, tx_last_5min_total bigint, tx_last_5min_failed bigint, avg_amount_24h double, "
        "velocity_score double, device_change_flag boolean, failed_attempts_30min bigint, hard_block boolean"))
    mismatch = spark.createDataFrame([], "transaction_id string, country_mismatch_flag boolean, country_risk_score double")
    requests = file_stream(spark, source, tx.schema).select("user_id", "transaction_id")
    messages = run(alert_messages(decide_requests(requests, users, mismatch)), tmp_path, "scored")
    topics = {r.topic: r["count"] for r in messages.groupBy("topic").count().collect()}
    blocked = tx.where("user_id = 'user-1'").count()
    assert topics == {"fraud-alerts": blocked, "cleared-transactions": tx.count() - blocked}


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = (streams.shared_folder(spark, "x") for _ in range(2))
    assert first != second
    if root:
        assert first.startswith(root)
