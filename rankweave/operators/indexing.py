"""Dense integer ids for string keys, built without bringing the keys to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.joins import skew_safe_join

#: Hex digits of the hash prefix: 16^3 = 4096 groups, which bounds the table of group offsets that is broadcast.
PREFIX_DIGITS = 3


def index_ids(df: DataFrame, column: str, output: str) -> DataFrame:
    """(column, output): each distinct value with an index 0, 1, 2, ... in order of (hash prefix, value).

    A single ranking would sort all ids in one task. Ids are numbered inside 4096 hash groups instead, and each group
    starts after the sizes of the groups before it.
    """
    ids = (
        df.select(F.col(column))
        .where(F.col(column).isNotNull())
        .distinct()
        .withColumn("_group", F.substring(F.md5(F.col(column).cast("string")), 1, PREFIX_DIGITS))
    )
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ids.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_group").orderBy(column)) - 1
    return (
        ids.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_group")
        .select(column, (F.col("_offset") + F.col("_inside")).cast("int").alias(output))
    )


def with_index(
    df: DataFrame, index: DataFrame, column: str, how: str = "inner", counts: DataFrame | None = None
) -> DataFrame:
    """`df` with the index column of `index_ids` joined on."""
    return skew_safe_join(df, index, [column], how, counts=counts)
