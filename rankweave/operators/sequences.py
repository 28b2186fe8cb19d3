"""Interaction sequences per user or item, whole and in order, also for users with billions of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.joins import null_safe_join

#: Longest list that is put into one row. A longer sequence continues in further rows (`part` 1, 2, ...).
PART_SIZE = 100_000


def ordered_positions(
    df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Column, output: str = "_position"
) -> DataFrame:
    """Append the 0-based position of each row in its group without bringing the group into one task.

    `bucket` must not decrease along `order` (for example the minute of the first order column). Rows are numbered
    inside (group, bucket); the sizes of the buckets before it, a small table, give the offset. Null keys are a group
    like any other, and rows without an order value come first in theirs: no row is lost.
    """
    keys = [*group, "_bucket"]
    bucketed = df.withColumn("_bucket", bucket)
    sizes = bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    numbered = bucketed.withColumn("_inside", F.row_number().over(inside) - 1)
    joined = null_safe_join(numbered, offsets, keys, "inner")
    return joined.withColumn(output, F.col("_offset") + F.col("_inside")).drop("_bucket", "_inside", "_offset")


def collect_sequences(
    df: DataFrame,
    group: Sequence[str],
    item: str,
    order: Sequence[str] = ("ts", "event_id"),
    output: str = "items",
    min_size: int = 1,
    part_size: int = PART_SIZE,
    bucket: Column | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """(group..., part, output array): the items of each group in order, split into parts of `part_size`.

    Groups up to `part_size` are collected in one aggregation and have the single part 0. Longer ones are numbered
    with `ordered_positions` first, so that no task ever holds more than `part_size` items of a group. Which groups are
    long is a count over the group columns, part of the same plan: no job runs while it is built, and adaptive execution
    drops the branch of long groups where there are none. `sized_by` is a cheaper table with at least as many rows per
    group to count instead.

    The items and their order are the same for every `part_size`: the parts of a group, one after the other, are its
    whole list (`sequence_items` gives it row by row). Null keys and null order values (first) take part.
    """
    group = list(group)
    bucket = F.date_trunc("minute", F.col(order[0])) if bucket is None else bucket
    rows = df.where(F.col(item).isNotNull()).select(*dict.fromkeys([*group, *order, item]))

    def gather(part_rows: DataFrame, smallest: int) -> DataFrame:
        entry = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(item).alias("_item"))
        lists = part_rows.groupBy(*group, "part").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        if smallest > 1:
            lists = lists.where(F.size("_entries") >= smallest)
        return lists.select(*group, "part", F.col("_entries._item").alias(output))

    sizes = (rows if sized_by is None else sized_by).groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    long_groups = sizes.where(F.col("_n") > part_size).select(*group)
    # At most rows / part_size groups; Spark picks both joins by the measured size.
    short = null_safe_join(rows, long_groups, group, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    long = ordered_positions(null_safe_join(rows, long_groups, group, "left_semi"), group, order, bucket)
    long = long.withColumn("part", F.floor(F.col("_position") / F.lit(part_size)).cast("bigint")).drop("_position")
    enough = long.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_size).select(*group)
    kept = long if sized_by is None or min_size <= 1 else null_safe_join(long, enough, group, "left_semi")
    return gather(short, min_size).unionByName(gather(kept, 1))


def sequence_items(sequences: DataFrame, group: Sequence[str], output: str = "items", part_size: int = PART_SIZE) -> DataFrame:
    """(group..., position, item) of collected sequences: one row per item, the same for every `part_size`."""
    rows = sequences.select(*group, "part", F.posexplode(output).alias("_at", "item"))
    return rows.select(*group, (F.col("part") * part_size + F.col("_at")).cast("bigint").alias("position"), "item")


def item_positions(df: DataFrame, group: Sequence[str], item: str, order: Sequence[str] = ("ts", "event_id"), bucket: Column | None = None) -> DataFrame:
    """(group..., position, item): the sequences in their long form, without any list, whatever the size of a group."""
    bucket = F.date_trunc("minute", F.col(order[0])) if bucket is None else bucket
    rows = df.where(F.col(item).isNotNull()).select(*dict.fromkeys([*group, *order, item]))
    placed = ordered_positions(rows, list(group), order, bucket)
    return placed.select(*group, F.col("_position").cast("bigint").alias("position"), F.col(item).alias("item"))


def _positive(df: DataFrame, options: dict) -> DataFrame:
    if options.get("sized_by") is not None:
        options["sized_by"] = options["sized_by"].where(F.col("label") == 1)
    return df.where(F.col("label") == 1)


def user_sequences(df: DataFrame, order: Sequence[str] = ("ts", "event_id"), **options) -> DataFrame:
    """Positive items of each user with more than one of them, as `feeds`."""
    positive = _positive(df, options)
    return collect_sequences(positive, ["device_id"], "feed_id", order, "feeds", min_size=2, **options)


def item_sequences(df: DataFrame, order: Sequence[str] = ("ts", "event_id"), **options) -> DataFrame:
    """Positive users of each item with more than one of them, as `users`."""
    positive = _positive(df, options)
    return collect_sequences(positive, ["feed_id"], "device_id", order, "users", min_size=2, **options)


def user_history(df: DataFrame, dt: Column, order: Sequence[str] = ("ts", "event_id"), **options) -> DataFrame:
    """Positive items of each user with the day stamp `dt`, as `feeds`; no lower limit on the size."""
    positive = df.where(F.col("label") == 1).withColumn("dt", dt)
    return collect_sequences(positive, ["device_id", "dt"], "feed_id", order, "feeds", **options)


def positive_lists(df: DataFrame, order: Sequence[str] = ("ts", "event_id"), **options) -> DataFrame:
    """Positive items of each user as an array `label`, for ranking evaluation."""
    positive = _positive(df, options)
    return collect_sequences(positive, ["device_id"], "feed_id", order, "label", **options)


def as_text(df: DataFrame, column: str) -> DataFrame:
    """The list column joined by blanks, as the embedding trainers read it."""
    return df.withColumn(column, F.array_join(F.col(column).cast("array<string>"), " "))
