"""Validation, defaults, event time, lateness and de-duplication of decoded transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cardpulse.schema import DEFAULT_CURRENCY, REQUIRED_FIELDS, STATUSES, WATERMARK


def keep_decoded(df: DataFrame) -> DataFrame:
    """B1: rows whose body could be read."""
    return df.where(F.col("transaction_id").isNotNull())


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Add ``reject_reason``: the first missing required field or an unknown status; null for a good row."""
    checks = [F.when(F.col(name).isNull(), f"missing {name}") for name in REQUIRED_FIELDS]
    checks.append(F.when(~F.col("status").isin(*STATUSES), "unknown status"))
    return df.withColumn("reject_reason", F.coalesce(*checks))


def violation_rules() -> dict[str, Column]:
    """Every rule of a transaction by its name; true where a row violates it."""
    rules = {f"missing {name}": F.col(name).isNull() for name in REQUIRED_FIELDS}
    return rules | {"unknown status": F.coalesce(~F.col("status").isin(*STATUSES), F.lit(False))}


def with_violations(df: DataFrame) -> DataFrame:
    """A4: add ``violations``, the names of all rules that a row violates, in their order; empty for a good row."""
    named = [F.when(broken, name) for name, broken in violation_rules().items()]
    return df.withColumn("violations", F.array_compact(F.array(*named)))


def count_violations(df: DataFrame, name: str = "violations") -> tuple[DataFrame, Observation]:
    """K8 in the pass that writes the rows: ``df`` with an observation of ``rows`` and of how many violate each rule. The
    numbers are there once an action on ``df`` has ended. A stream takes ``name`` instead, see :func:`observed_stream`.
    """
    seen = Observation(name)
    return df.observe(seen, *_totals()), seen


def observed_stream(df: DataFrame, name: str = "violations") -> DataFrame:
    """The same on a stream: every micro-batch's progress holds its numbers under ``observedMetrics[name]``."""
    return df.observe(name, *_totals())


def _totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(broken).alias(rule) for rule, broken in violation_rules().items()]]


def conform_transactions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A4: (good, rejected). Good rows get the default currency and metadata; rejected rows keep what they had.

    On a stream each of the two is a query of its own; write both from one ``foreachBatch`` to read the source once.
    """
    judged = with_reject_reason(df)
    good = (
        judged.where(F.col("reject_reason").isNull())
        .drop("reject_reason")
        .withColumn("currency", F.coalesce("currency", F.lit(DEFAULT_CURRENCY)))
        .withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))
    )
    return good, judged.where(F.col("reject_reason").isNotNull())


def with_event_time(df: DataFrame) -> DataFrame:
    """A5: epoch milliseconds to timestamp, exactly."""
    return df.withColumn("event_time", F.timestamp_millis(F.col("event_time")))


def with_watermark(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """How late an event may come; without effect on a batch."""
    return df.withWatermark("event_time", delay)


def dedupe_transactions(df: DataFrame) -> DataFrame:
    """One row per ``transaction_id``. A stream needs a watermark and remembers ids for as long as it lasts."""
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(["transaction_id"])
    return df.dropDuplicates(["transaction_id"])
