"""Which batches count: one small file per batch, written after everything else of the batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

LAYOUT = "batch_id bigint, committed_at timestamp"


def commit_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """List a batch. A single file appears by a single rename, so that a batch is listed wholly or not at all."""
    spark.range(0, 1, 1, 1).select(
        F.lit(int(batch_id)).cast("bigint").alias("batch_id"), F.current_timestamp().alias("committed_at"),
    ).write.mode("overwrite").json(f"{path.rstrip('/')}/commit={int(batch_id)}")


def committed_batches(spark: SparkSession, path: str, after: int | None = None) -> list[int]:
    """The listed batches, ascending: one number per batch, and with ``after`` (the last folded one) only per batch that
    compaction has not folded yet. None where nothing has been listed.
    """
    try:
        rows = spark.read.schema(LAYOUT).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if after is not None:
        rows = rows.where(F.col("commit") > after)
    return sorted(r.batch_id for r in rows.select("batch_id").distinct().collect())


def unbroken(batches: list[int], after: int = -1) -> int:
    """The last batch of the run without gaps that follows ``after``; a batch behind a gap may still be overtaken."""
    for batch in batches:
        if batch > after + 1:
            break
        after = max(after, batch)
    return after
