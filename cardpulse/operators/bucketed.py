"""Online tables bucketed by entity: lookups and folds meet the stored rows where they lie.

The rows of an entity are in one bucket of every batch, so taking its newest one needs no shuffle, and a lookup
shuffles the requests only. The session's catalog keeps the number of buckets; a plain path could not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.operators.quality import latest_by_key
from cardpulse.operators.store import _moment, online_rows
from cardpulse.schema import FeatureView


def create_bucketed(spark: SparkSession, view: FeatureView, table: str, like: DataFrame, path: str, buckets: int) -> None:
    """An empty table for the rows of ``like`` (feature rows of ``view``), its files below ``path``.

    ``buckets`` stays for the table's life: choose it so that a bucket of all batches fits a task, and no smaller than
    the ``spark.sql.shuffle.partitions`` of the sessions that look up, or Spark prefers to shuffle both sides.
    """
    empty = online_rows(like, view, F.lit(None).cast("timestamp")).where(F.lit(False)).withColumn(
        "batch_id", F.lit(0).cast("bigint"))
    empty.write.partitionBy("batch_id").bucketBy(buckets, *view.entity).sortBy(*view.entity).option(
        "path", path).saveAsTable(table, format="parquet")


def _buckets(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"describe extended {table}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def write_bucketed(
    df: DataFrame, view: FeatureView, table: str, batch_id: int, written_at=None, slide: str | None = None
) -> None:
    """A9 into a bucketed table: the batch's rows replace those of the same batch. One file per bucket: rows are dealt
    out by the function that buckets them.
    """
    spark = df.sparkSession
    names = [c for c in spark.table(table).columns if c != "batch_id"]
    rows = online_rows(df, view, written_at, slide).select(*names)
    spark.sql(
        f"insert overwrite table {table} partition (batch_id = {int(batch_id)}) select * from {{rows}}",
        rows=rows.repartition(_buckets(spark, table), *view.entity))


def read_bucketed(spark: SparkSession, view: FeatureView, table: str, as_of=None) -> DataFrame:
    """The live value of every entity at ``as_of`` (now unless given), still bucketed by entity."""
    at = F.current_timestamp() if as_of is None else _moment(as_of)
    current = latest_by_key(spark.table(table), view.entity, (*view.recency, "batch_id"))
    return current.where(at < F.col("expires_at"))
