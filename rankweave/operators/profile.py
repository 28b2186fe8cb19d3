"""Profiles of a feature table: missing rates, summaries, tag vocabulary and hash collisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.byte_hash import byte_hash
from rankweave.functions.tag_hash import DEFAULT_SEED, tag_hash
from rankweave.functions.tags import split_parts


def _is_missing(field: T.StructField) -> Column:
    column = F.col(field.name)
    missing = column.isNull()
    if isinstance(field.dataType, T.StringType):
        missing = missing | (column == "")
    elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def missing_rates(df: DataFrame, label: str = "label") -> DataFrame:
    """(column, positive_rate, negative_rate): share of null, empty or NaN values in each class.

    One aggregation over all columns; the result is turned into one row per column afterwards.
    """
    fields = df.schema.fields
    rates = []
    for i, field in enumerate(fields):
        missing = _is_missing(field).cast("double")
        rates.append(F.avg(F.when(F.col(label) == 1, missing)).alias(f"p{i}"))
        rates.append(F.avg(F.when(F.col(label) == 0, missing)).alias(f"n{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column"),
                F.col(f"p{i}").alias("positive_rate"),
                F.col(f"n{i}").alias("negative_rate"),
            )
            for i, field in enumerate(fields)
        ]
    )
    return df.agg(*rates).select(F.inline(rows))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max) of numeric columns, in one aggregation."""
    parts = []
    for i, name in enumerate(columns):
        value = F.col(name).cast("double")
        parts += [
            F.count(value).alias(f"c{i}"),
            F.avg(value).alias(f"a{i}"),
            F.stddev_samp(value).alias(f"s{i}"),
            F.min(value).alias(f"l{i}"),
            F.max(value).alias(f"h{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"c{i}").alias("count"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"s{i}").alias("stddev"),
                F.col(f"l{i}").alias("min"),
                F.col(f"h{i}").alias("max"),
            )
            for i, name in enumerate(columns)
        ]
    )
    return df.agg(*parts).select(F.inline(rows))


def vector_stats(df: DataFrame, vector: str) -> DataFrame:
    """(dim, min, max, mean, variance, nonzeros) per dimension of an ML vector column."""
    summary = df.agg(
        Summarizer.metrics("min", "max", "mean", "variance", "numNonZeros").summary(F.col(vector)).alias("s")
    )
    arrays = F.arrays_zip(
        *[
            vector_to_array(F.col(f"s.{name}")).alias(name)
            for name in ("min", "max", "mean", "variance", "numNonZeros")
        ]
    )
    rows = summary.select(F.posexplode(arrays).alias("dim", "v"))
    return rows.select(
        "dim",
        F.col("v.min").alias("min"),
        F.col("v.max").alias("max"),
        F.col("v.mean").alias("mean"),
        F.col("v.variance").alias("variance"),
        F.col("v.numNonZeros").cast("bigint").alias("nonzeros"),
    )


def tag_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct tags (with their scores, as written) of a tag string column."""
    return df.select(F.explode(split_parts(F.col(column), ",")).alias("tag")).distinct()


def hash_collisions(df: DataFrame, column: str, algorithm: str = "tag", buckets: int = 300, mode: str = "sane") -> DataFrame:
    """(bucket, tags): how many distinct tags of a column share a hash bucket.

    algorithm "tag" is the 32-bit tag hash, "hash32" and "hash64" hash the bytes. mode="reference" drops the two last
    characters of each tag and, for byte hashes, computes `hash % (buckets/2) + buckets/2` with the sign of the hash.
    """
    tag = F.col("tag")
    if mode == "reference":
        tag = F.expr("substring(tag, 1, greatest(length(tag) - 2, 0))")
    vocabulary = tag_vocabulary(df, column)
    if algorithm == "tag":
        bucket = tag_hash(tag, DEFAULT_SEED) % F.lit(buckets)
    else:
        hashed = byte_hash(tag, algorithm).cast("bigint")
        half = buckets // 2
        bucket = hashed % F.lit(half) + half if mode == "reference" else F.pmod(hashed, F.lit(buckets).cast("bigint"))
    return vocabulary.groupBy(bucket.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("tags"))


def duplicate_groups(df: DataFrame, column: str, output: str = "hash128") -> DataFrame:
    """(hash128 as two bigints, copies): exact-duplicate groups of a text column by its 128-bit byte hash."""
    hashed = df.select(byte_hash(F.col(column), "hash128").alias(output))
    return hashed.groupBy(F.col(output)[0].alias("h1"), F.col(output)[1].alias("h2")).agg(
        F.count(F.lit(1)).alias("copies")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows and number of distinct values of each column."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_distinct(c).alias(f"distinct_{c}") for c in columns]
    )


def label_range(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: smallest and largest label, for clipping regression scores."""
    return df.agg(F.min(label).alias("min_target"), F.max(label).alias("max_target"))
