"""Sparse rows in Arrow batches, shared by the factorization machines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def vector_parts(vector: Column) -> tuple[Column, Column]:
    """Indices and values of an ML vector, dense or sparse, as arrays."""
    raw = F.unwrap_udt(vector)
    positions = F.transform(raw["values"], lambda _, i: i)
    return F.when(raw["type"] == 0, raw["indices"]).otherwise(positions), raw["values"]


def sparse_rows(df: DataFrame, features: str, label: str) -> DataFrame:
    """(label, indices, values) of a labelled vector table."""
    indices, values = vector_parts(F.col(features))
    return df.select(F.col(label).cast("double").alias("label"), indices.alias("indices"), values.alias("values"))


def flat_list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the row number of each."""
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


@dataclass
class SparseBatch:
    label: np.ndarray
    row: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    @property
    def size(self) -> int:
        return len(self.label)


def read_batches(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[SparseBatch]:
    for batch in batches:
        feature, row = flat_list(batch.column("indices"))
        value, _ = flat_list(batch.column("values"))
        if len(feature) and int(feature.max()) >= n_features:
            raise ValueError(f"feature {int(feature.max())} is outside of the model's {n_features}")
        yield SparseBatch(
            batch.column("label").to_numpy(zero_copy_only=False), row, feature.astype(np.int64), value.astype(np.float64)
        )
