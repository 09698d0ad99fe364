"""Scoring tables with a trained model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tabsift.operators.cleaning import align_features


def score_batch(df: DataFrame, model: PipelineModel, features: list[str], keep: list[str]) -> DataFrame:
    """Probability of class 1 beside the kept columns. Works on tables and streams.

    Features are brought into model order: absent ones 0, missing values filled.
    """
    aligned = align_features(df, features, keep)
    probability = vector_to_array(F.col("probability"))
    return model.transform(aligned).select(*keep, F.get(probability, F.lit(1)).alias("score"))
