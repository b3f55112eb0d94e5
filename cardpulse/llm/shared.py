"""Helpers that the operators of this subpackage share: shared folders and running values in global order."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else one below the session's warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written once to the shared folder: later readers neither recompute it nor depend on the
    executors that made it. Each call has a folder of its own; emptying the shared folder is its owner's business.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def running_last(rows: DataFrame, value: str, order: list[str], out: str, name: str) -> DataFrame:
    """For each row, the last non-null ``value`` at or before it in the global order of ``order``.

    Rows are range-partitioned, so no task holds more than its range; each range starts with the value that the
    ranges before it end with (one row per range, the only thing that is broadcast).
    """
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, name)
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = ranged.where(F.col(value).isNotNull()).groupBy("_range").agg(
        F.max(F.struct(*order, value))[value].alias("_end"))
    ranges = ranged.select("_range").distinct().join(ends, "_range", "left")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select("_range", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    swept = ranged.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
    return swept.join(F.broadcast(carried), "_range").withColumn(
        out, F.coalesce("_inside", "_carried")).drop("_range", "_inside", "_carried")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
