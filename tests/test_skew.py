"""Lookups in which one key holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from cardpulse.operators.skew import lookup_join, row_digest


@pytest.fixture()
def large(spark):
    """As for large tables: nothing is small enough to broadcast, and a third of these rows is a large partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def sides(spark):
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else 'u' || id % 700 end as user_id")
    facts = spark.range(650).selectExpr("'u' || id as user_id", "id as value").unionByName(
        spark.sql("select 'hot' as user_id, -1L as value"))
    return rows, facts


def test_the_final_plan_splits_a_hot_key(spark, large, tmp_path):
    rows, facts = sides(spark)
    joined = lookup_join(rows, facts, ["user_id"])
    got = joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert len(got) == 200_000
    assert sum(r.value == -1 for r in got) == sum(r.user_id == "hot" for r in got) == 66_667


def test_spread_deals_a_key_out_and_results_stay_whole(spark, large):
    rows, facts = sides(spark)
    plain = rows.join(facts, "user_id", "left").select("id", "user_id", "value")
    spread = lookup_join(rows, facts, ["user_id"], spread=8)
    assert spread.columns == ["id", "user_id", "value"]
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        tasks = spread.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert max(t.n for t in tasks) < 66_667


def test_the_digest_reads_stable_columns_only(spark):
    df = spark.sql("select 'a' as name, 1L as n, 0.1D as x union all select 'a', 1L, 0.2D")
    assert df.select(row_digest(df).alias("d")).distinct().count() == 1
