"""From feature rows to decisions and messages."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.schema import ALERT_THRESHOLD, ALERT_TOPIC, CLEARED_TOPIC, FEATURE_ORDER


def numeric_features(df: DataFrame, prefix: str = "") -> DataFrame:
    """The model's inputs as doubles in fixed order; null, false and absent columns count as 0.0."""
    present = set(df.columns)
    values = [
        (F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in present else F.lit(0.0)).alias(prefix + name)
        for name in FEATURE_ORDER
    ]
    kept = [c for c in df.columns if prefix or c not in FEATURE_ORDER]
    return df.select(*kept, *values)


def assemble_vector(df: DataFrame, output: str = "features") -> DataFrame:
    """K4: add the model's input vector; the feature columns stay as they are."""
    assembler = VectorAssembler(inputCols=["_x_" + name for name in FEATURE_ORDER], outputCol=output)
    return assembler.transform(numeric_features(df, "_x_")).drop(*["_x_" + name for name in FEATURE_ORDER])


def score(df: DataFrame, model=None) -> DataFrame:
    """K5: add ``score``, the probability of class 1 rounded to four places; 0.0 without a model.

    ``model`` is a fitted Spark ML classifier or pipeline reading ``features`` and writing ``probability``.
    """
    if model is None:
        return df.withColumn("score", F.lit(0.0))
    scored = model.transform(assemble_vector(df))
    return scored.select(*df.columns, F.round(vector_to_array("probability")[1], 4).alias("score"))


def decide(df: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """K6: add ``decision`` and settle ``score``: a hard block overrides the model."""
    blocked = F.coalesce(F.col("hard_block"), F.lit(False))
    decision = F.when(blocked, "BLOCKED").when(F.col("score") >= threshold, "FRAUD").otherwise("CLEARED")
    return df.withColumn("decision", decision).withColumn(
        "score", F.when(blocked, 1.0).otherwise(F.col("score")))


def route_decisions(decided: DataFrame) -> DataFrame:
    """One message per decision; the Kafka writer takes the topic from the column."""
    return decided.select(
        F.when(F.col("decision") == "CLEARED", CLEARED_TOPIC).otherwise(ALERT_TOPIC).alias("topic"),
        F.col("transaction_id").cast("binary").alias("key"),
        F.to_json(F.struct("transaction_id", "score", "decision")).cast("binary").alias("value"),
    )
