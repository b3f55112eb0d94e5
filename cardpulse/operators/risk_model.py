"""K5 fitted: a naive Bayes classifier over the model's inputs, each as a bit that is set above a limit."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import Binarizer, ElementwiseProduct
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.operators.scoring import assemble_vector
from cardpulse.schema import FEATURE_ORDER

# A bit is set above these values: powers of two, by which scaling is exact.
LIMITS = {
    "tx_last_5min_total": 2.0, "tx_last_5min_failed": 0.5, "avg_amount_24h": 256.0, "velocity_score": 0.125,
    "device_change_flag": 0.5, "failed_attempts_30min": 0.5, "country_risk_score": 0.25,
}


def fit_risk_model(
    training: DataFrame, limits: dict[str, float] = LIMITS, smoothing: float = 1.0, label: str = "label"
) -> PipelineModel:
    """Fit on a training set (inputs by name, absent and null ones count as 0.0; label 0 or 1, rows without one are left
    out). One pass counts the rows of each class by their bits, two to the power of the inputs at most; the classifier,
    which runs through its rows more than once, is fitted on those counts. Both classes must occur.

    The model reads ``features`` and writes ``probability``, as :func:`cardpulse.operators.scoring.score` wants it, and
    is saved and loaded like any Spark ML pipeline.
    """
    rows = assemble_vector(training.where(F.col(label).isNotNull())).select(
        "features", F.col(label).cast("double").alias("_label"))
    scale = Vectors.dense([1.0 / limits[name] for name in FEATURE_ORDER])
    to_bits = [
        ElementwiseProduct(scalingVec=scale, inputCol="features", outputCol="_scaled"),
        Binarizer(threshold=1.0, inputCol="_scaled", outputCol="_bits"),
    ]
    bits = PipelineModel(to_bits).transform(rows).select(vector_to_array("_bits").alias("_bits"), "_label")
    counted = bits.groupBy("_bits", "_label").agg(F.count("*").cast("double").alias("_weight")).select(
        array_to_vector("_bits").alias("_bits"), "_label", "_weight").persist()
    try:
        bayes = NaiveBayes(
            modelType="bernoulli", smoothing=smoothing, featuresCol="_bits", labelCol="_label", weightCol="_weight").fit(counted)
    finally:
        counted.unpersist()
    if bayes.numClasses != 2:
        raise ValueError("training needs rows of both classes")
    return PipelineModel([*to_bits, bayes])
