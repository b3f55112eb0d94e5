"""Shape of the physical plans: what is read, what is shuffled, what must not appear."""

import re

import pytest

from cardpulse.operators import features
from cardpulse.plans import adapter
from cardpulse.plans.catalog import QUERIES

EAGER = {"online_latest", "stream_tx_counts", "stream_velocity_online"}  # their last plan only reads a table


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_no_cross_join(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    for forbidden in ("EvalPython", "PythonUDF", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
                      "SinglePartition, REPARTITION"):
        assert forbidden not in plan


@pytest.mark.parametrize("name, shuffles", [
    ("f01_tx_counts", 2), ("f02_amount_stats", 2), ("f04_velocity", 2), ("f06_failed_attempts", 2),
    ("f05_device_change", 4), ("f07_tumbling_velocity", 1), ("user_features_wide", 8), ("user_features_joined", 12),
    ("pk_violations", 1), ("tx_conformed", 0), ("tx_decoded", 0), ("f03_country_risk", 0),
])
def test_number_of_shuffles(spark, sf_dir, name, shuffles):
    assert physical(QUERIES[name](spark, sf_dir)).count("Exchange hashpartitioning") == shuffles


@pytest.mark.parametrize("name, columns", [
    ("f04_velocity", {"ts", "user_id"}),
    ("f01_tx_counts", {"ts", "user_id", "event_type"}),
    ("f02_amount_stats", {"ts", "user_id", "event_type", "value"}),
    ("f05_device_change", {"ts", "user_id", "props"}),
])
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", physical(QUERIES[name](spark, sf_dir)))
    assert {part.split(":")[0] for schema in read for part in schema.split(",")} == columns


def test_feature_filters_on_a_stored_table_are_pushed(spark, tmp_path, sf_dir):
    path = str(tmp_path / "tx")
    adapter.transactions(spark, sf_dir).write.parquet(path)
    tx = spark.read.parquet(path)
    amounts = physical(features.amount_stats(tx))
    assert "EqualTo(status,APPROVED)" in amounts
    assert "ReadSchema: struct<user_id:string,amount:double,status:string,event_time:timestamp>" in amounts
    assert "IsNotNull(device_id)" in physical(features.device_change(tx))


def test_labels_filter_on_a_stored_table_is_pushed(spark, tmp_path, sf_dir):
    from cardpulse.sources.tables import labels_between

    path = str(tmp_path / "labels")
    adapter.label_table(spark, sf_dir).write.parquet(path)
    plan = physical(labels_between(spark.read.parquet(path), "2024-01-01 00:30:00", "2024-01-01 01:00:00"))
    assert "GreaterThanOrEqual(event_timestamp" in plan and "LessThanOrEqual(event_timestamp" in plan
