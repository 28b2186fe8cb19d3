"""Joins that keep their parallelism when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A task should not get more rows of one key than this; keys above it are split into shares.
SHARE_ROWS = 1_000_000

#: This many hot keys are sent to all tasks at most. If there are more, their table is joined like any other.
MAX_HOT_KEYS = 10_000

_NULL_KEY_SHARES = 1024


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _rows): rows per key. One table of a log's keys serves filters on counts and all joins of that log."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(counts: DataFrame, keys: Sequence[str], share_rows: int = SHARE_ROWS) -> DataFrame | None:
    """(keys, _shares) of all keys with more than `share_rows` rows in `key_counts`; None when there are none.

    Up to MAX_HOT_KEYS keys come back as a local table marked for broadcasting; a longer list stays a distributed one,
    and every key in it is split too. This runs a job over the counts.
    """
    shares = F.ceil(F.col("_rows") / F.lit(share_rows)).cast("int").alias("_shares")
    found = counts.where(F.col("_rows") > share_rows).select(*keys, shares)
    rows = found.limit(MAX_HOT_KEYS + 1).collect()
    if len(rows) > MAX_HOT_KEYS:
        return found
    return F.broadcast(counts.sparkSession.createDataFrame(rows, found.schema)) if rows else None


def _any_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys; the key columns are the left side's."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in on})
    same = F.lit(True)
    for key in on:
        same = same & left[key].eqNullSafe(renamed[f"_right_{key}"])
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in on])


def skew_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salt_by: Sequence[str] | None = None,
    share_rows: int = SHARE_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of a large, possibly skewed `left` with `right`, which is unique or narrow per key.

    Without `counts` this is the plain join and starts no job: adaptive execution broadcasts a small right side by its
    measured size and splits skewed partitions. With the `key_counts` of the left side, rows of hot keys are spread over shares by a hash of `salt_by` (all columns by default; name an id column
    when many rows are exact copies) and the matching right rows are copied into each share. A row's share depends on
    its values only, so a task that is run again after a lost executor puts it in the same place.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} cannot be split on the left")
    on = list(on)
    hot = None if counts is None else hot_keys(counts, on, share_rows)
    if hot is None:
        return left.join(right, on, how)
    row_hash = F.xxhash64(*[F.col(c) for c in (salt_by or left.columns)])
    shares = F.when(_any_null(on), F.lit(_NULL_KEY_SHARES)).otherwise(F.coalesce(F.col("_shares"), F.lit(1)))
    salted = left.join(hot, on, "left").withColumn(
        "_share", F.pmod(row_hash, shares.cast("bigint")).cast("int")
    )
    numbers = F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1)
    copied = right.join(hot, on, "left").withColumn("_share", F.explode(numbers)).drop("_shares")
    return salted.drop("_shares").join(copied, [*on, "_share"], how).drop("_share")
