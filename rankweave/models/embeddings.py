"""Skip-gram embeddings of items and users from interaction sequences."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VECTOR_WIDTH = 100


def train_embeddings(
    sequences: DataFrame,
    column: str,
    width: int = VECTOR_WIDTH,
    window: int = 5,
    min_count: int = 5,
    iterations: int = 1,
    partitions: int | None = None,
    step: float = 0.025,
    seed: int = 12345,
) -> DataFrame:
    """(id, vec): skip-gram vectors of the words of an array column.

    Each partition trains on its own sequences and the vectors are averaged per iteration, so more partitions train
    faster and need more iterations; the default follows the session's cores. Long sequences may come in parts; training
    reads them in windows anyway.
    """
    partitions = partitions or max(8, sequences.sparkSession.sparkContext.defaultParallelism)
    model = Word2Vec(
        vectorSize=width,
        windowSize=window,
        minCount=min_count,
        maxIter=iterations,
        numPartitions=partitions,
        stepSize=step,
        inputCol=column,
        outputCol="_mean",
        seed=seed,
    ).fit(sequences.select(column))
    return model.getVectors().select(F.col("word").alias("id"), vector_to_array("vector").alias("vec"))
