"""Static tables beside the stream: user profiles and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def user_profiles(table: DataFrame) -> DataFrame:
    """(user_id, home_country) of a profile table (user_id, country)."""
    return table.select("user_id", F.col("country").alias("home_country"))


def labels_between(table: DataFrame, start, end) -> DataFrame:
    """Labels whose event time lies in the closed range; start and end are timestamps or columns."""
    start, end = (v if isinstance(v, Column) else F.lit(v).cast("timestamp") for v in (start, end))
    return table.where(F.col("event_timestamp").between(start, end)).select(
        "user_id", "transaction_id", "label", "event_timestamp")
