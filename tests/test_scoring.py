"""Vector, score, decision, message; table checks."""

import json

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cardpulse.operators import quality, risk_model, scoring
from cardpulse.plans.scored import alert_messages, decide_requests
from cardpulse.schema import FEATURE_ORDER
from conftest import at

FEATURES = ("transaction_id string, tx_last_5min_total bigint, tx_last_5min_failed bigint, avg_amount_24h double, "
            "velocity_score double, device_change_flag boolean, failed_attempts_30min bigint, "
            "country_risk_score double, hard_block boolean")


def test_vector_order_and_zeros(spark):
    df = spark.createDataFrame([("a", 1, 2, 3.5, 0.4, True, 6, 0.8, None), ("b", *[None] * 8)], FEATURES)
    got = {r.transaction_id: list(r.features) for r in scoring.assemble_vector(df).collect()}
    assert got == {"a": [1.0, 2.0, 3.5, 0.4, 1.0, 6.0, 0.8], "b": [0.0] * 7}
    absent = scoring.assemble_vector(df.drop("avg_amount_24h", "device_change_flag")).first()
    assert list(absent.features) == [1.0, 2.0, 0.0, 0.4, 0.0, 6.0, 0.8]
    assert scoring.assemble_vector(df).columns == [*df.columns, "features"]


def test_score_with_a_saved_spark_model(spark, tmp_path):
    train = spark.range(200).selectExpr(
        "cast(id % 2 as double) as label", "'t' || id as transaction_id",
        *[f"cast((id * {i + 3}) % 17 + 5 * (id % 2) as double) as {n}" for i, n in enumerate(FEATURE_ORDER)])
    fitted = Pipeline(stages=[LogisticRegression(maxIter=5, regParam=0.1)]).fit(scoring.assemble_vector(train))
    fitted.save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    scored = scoring.score(train, model)
    assert scored.columns == [*train.columns, "score"]
    rows = scored.collect()
    assert all(0.0 <= r.score <= 1.0 and round(r.score, 4) == r.score for r in rows)
    risky, calm = ([r.score for r in rows if r.label == v] for v in (1.0, 0.0))
    assert sum(risky) / len(risky) > sum(calm) / len(calm)


def test_the_fitted_model_is_naive_bayes(spark, tmp_path):
    import math

    rows = [(i, int(i % 3 == 0), float(i % 5), i % 2, None if i % 4 else 0.5) for i in range(60)]
    train = spark.createDataFrame(
        [*rows, (60, None, 9.0, 1, 0.5)],
        "id int, label int, tx_last_5min_total double, failed_attempts_30min int, country_risk_score double")
    risk_model.fit_risk_model(train).save(str(tmp_path / "m"))
    scored = scoring.score(train, PipelineModel.load(str(tmp_path / "m")))
    assert scored.columns == [*train.columns, "score"]

    def bits(row):
        return [row[2] > 2, False, False, False, False, row[3] > 0.5, (row[4] or 0) > 0.25]

    def weight(row, label):
        mine = [bits(r) for r in rows if r[1] == label]
        total = math.log(len(mine) + 1) - math.log(len(rows) + 2)
        for i, bit in enumerate(bits(row)):
            share = (sum(b[i] for b in mine) + 1) / (len(mine) + 2)
            total += math.log(share if bit else 1 - share)
        return total

    for r in scored.collect():
        want = 1 / (1 + math.exp(weight(tuple(r), 0) - weight(tuple(r), 1)))
        assert abs(r.score - want) <= 0.00005 + 1e-9
    with pytest.raises(ValueError):
        risk_model.fit_risk_model(train.where("label = 0"))


def test_fitting_computes_the_training_set_once(spark):
    """The classifier asks for its rows several times; the costly set behind them must not be computed each time."""
    seen = spark.sparkContext.accumulator(0)

    def counting(rows):
        for row in rows:
            seen.add(1)
            yield row

    rows = spark.range(0, 300, 1, 3).selectExpr("cast(id % 3 = 0 as int) as label", "cast(id % 5 as double) as tx_last_5min_total")
    # A shuffle behind the rows, as a training set has.
    train = spark.createDataFrame(rows.rdd.mapPartitions(counting), rows.schema).repartition(4, "label", "tx_last_5min_total")
    risk_model.fit_risk_model(train)
    assert seen.value == 300


def test_no_model_scores_zero(spark):
    assert scoring.score(spark.range(1)).first().score == 0.0


@pytest.mark.parametrize("score, block, expected", [
    (0.8499, False, (0.8499, "CLEARED", "cleared-transactions")),
    (0.85, False, (0.85, "FRAUD", "fraud-alerts")),
    (0.1, True, (1.0, "BLOCKED", "fraud-alerts")),
    (0.9, None, (0.9, "FRAUD", "fraud-alerts")),
    (0.0, None, (0.0, "CLEARED", "cleared-transactions")),
])
def test_decisions_and_messages(spark, score, block, expected):
    df = spark.createDataFrame([("t", score, block)], "transaction_id string, score double, hard_block boolean")
    message = alert_messages(scoring.decide(df)).first()
    body = json.loads(bytes(message.value))
    assert (body["score"], body["decision"], message.topic) == expected
    assert body["transaction_id"] == "t" and bytes(message.key) == b"t"


def test_requests_to_decisions(spark):
    users = spark.createDataFrame([("u", 1, 0, 5.0, 0.1, False, 0, True)],
                                  "user_id string, tx_last_5min_total bigint, tx_last_5min_failed bigint, "
                                  "avg_amount_24h double, velocity_score double, device_change_flag boolean, "
                                  "failed_attempts_30min bigint, hard_block boolean")
    tx = spark.createDataFrame([], "transaction_id string, country_mismatch_flag boolean, country_risk_score double")
    requests = spark.createDataFrame([("u", "t1"), ("v", "t2")], "user_id string, transaction_id string")
    got = {r.transaction_id: (r.score, r.decision) for r in decide_requests(requests, users, tx).collect()}
    assert got == {"t1": (1.0, "BLOCKED"), "t2": (0.0, "CLEARED")}


def test_keys_and_constraints(spark):
    labels = spark.createDataFrame(
        [("t1", "u", 0, at(0)), ("t1", "u", 1, at(1)), ("t2", None, 2, None), (None, "v", None, at(2))],
        "transaction_id string, user_id string, label int, event_timestamp timestamp")
    assert [tuple(r) for r in quality.check_primary_key(labels, ("transaction_id",)).collect()] == [("t1", 2)]
    report = {r.rule: r.violations for r in quality.check_constraints(
        labels, quality.CONSTRAINTS["labeled_transactions"]).collect()}
    assert report == {"transaction_id not null": 1, "user_id not null": 1, "label not null": 1,
                      "label in (0, 1)": 1, "event_timestamp not null": 1}
    latest = quality.latest_by_key(labels, ("transaction_id",), ("event_timestamp",))
    assert {r.transaction_id: r.label for r in latest.collect()} == {"t1": 1, "t2": 2, None: None}
    stamped = quality.with_created_at(labels, at(5)).select(F.unix_seconds("created_at")).first()[0]
    assert stamped == int(at(5).timestamp())
    assert "created_at" in quality.with_created_at(labels).columns
