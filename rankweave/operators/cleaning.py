"""Cleaning, de-duplication and sampling of labelled feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.functions.tags import MISSING_TAG
from rankweave.operators.joins import skew_safe_join

ID_COLUMNS = ("device_id", "feed_id", "label_date", "timestamp")
LABEL_KEY = ("label_date", "device_id", "feed_id")
MAX_RATING = 10.0
ITEM_ID_DIVISOR = 100


def positives(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label) == 1)


def negatives(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label) == 0)


def stable_fraction(*keys: Column) -> Column:
    """A number in [0, 1) that depends on the key values only, not on partitioning or retries."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def negative_ratio(df: DataFrame, rate: float, label: str = "label") -> DataFrame:
    """One row: the share of negatives to keep, min(1, positives * rate / negatives)."""
    counts = df.agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg")
    )
    return counts.select(
        F.when(F.col("neg") == 0, F.lit(1.0))
        .otherwise(F.least(F.lit(1.0), F.col("pos") * F.lit(float(rate)) / F.col("neg")))
        .alias("ratio")
    )


def sample_negatives(
    df: DataFrame, rate: float = 1, keys: Sequence[str] | None = None, seed: int = 12345, label: str = "label"
) -> DataFrame:
    """All positives, and negatives down to `rate` per positive.

    With `keys` the choice depends on the key values, so it repeats exactly anywhere; without, it is random by `seed`.
    Counting is one aggregate and the choice is one filter: no union, no second shuffle.
    """
    draw = stable_fraction(*[F.col(k) for k in keys]) if keys else F.rand(seed)
    ratio = negative_ratio(df, rate, label).scalar()
    return df.where((F.col(label) == 1) | ((F.col(label) == 0) & (draw < ratio)))


def fill_missing(df: DataFrame) -> DataFrame:
    """Missing strings become the empty tag, missing numbers 0; booleans stay."""
    return df.na.fill(MISSING_TAG).na.fill(0.0)


def drop_id_columns(df: DataFrame, columns: Sequence[str] = ID_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def best_label(
    df: DataFrame, tie_break: Sequence[Column] = (), key: Sequence[str] = LABEL_KEY, label: str = "label"
) -> DataFrame:
    """One row per (date, device, item): the one with the highest label, the first by `tie_break` among equals.

    A row-number limit of 1 is applied before the shuffle as well as after it, so many copies of one key shrink to
    one row per input partition.
    """
    order = [F.col(label).desc(), *tie_break]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") <= 1).select(*df.columns)


def best_label_join(df: DataFrame, key: Sequence[str] = LABEL_KEY, label: str = "label") -> DataFrame:
    """All rows that carry the highest label of their key, by joining the per-key maximum back (ties are kept)."""
    best = df.groupBy(*key).agg(F.max(label).alias(label))
    return skew_safe_join(df, best, [*key, label], "left_semi")


def multi_record_users(
    df: DataFrame,
    user: str = "device_id",
    item: str = "feed_id",
    min_records: int = 2,
    salt_by: Sequence[str] | None = None,
    share_rows: int | None = None,
) -> DataFrame:
    """Rows of users that have at least `min_records` rows with an item.

    With `share_rows`, users with more rows than that are split over several tasks, by the same counts.
    """
    counts = df.groupBy(user).agg(F.count(item).alias("_records"), F.count(F.lit(1)).alias("_rows"))
    users = counts.where(F.col("_records") >= min_records).select(user)
    if share_rows is None:
        return skew_safe_join(df, users, [user], "left_semi")
    return skew_safe_join(df, users, [user], "left_semi", salt_by, share_rows, counts)


def best_label_of_repeat_users(
    df: DataFrame,
    tie_break: Sequence[Column] = (),
    salt_by: Sequence[str] | None = None,
    share_rows: int | None = None,
) -> DataFrame:
    """`best_label` followed by `multi_record_users`, with the users found first.

    A user keeps several rows exactly when the user has several different (date, item) pairs, that is, when the
    smallest and the largest pair differ. That takes one map-side combined aggregate over the raw rows, so the
    de-duplicated rows need not be computed twice.
    """
    pair = F.struct("label_date", "feed_id")
    pairs = df.where(F.col("feed_id").isNotNull()).groupBy("device_id").agg(
        F.min(pair).alias("_low"), F.max(pair).alias("_high"), F.count(F.lit(1)).alias("_rows")
    )
    users = pairs.where(F.col("_low") != F.col("_high")).select("device_id")
    if share_rows is None:
        return best_label(skew_safe_join(df, users, ["device_id"], "left_semi"), tie_break)
    return best_label(skew_safe_join(df, users, ["device_id"], "left_semi", salt_by, share_rows, pairs), tie_break)


def active_users(df: DataFrame, min_days: int = 3, user: str = "device_id", date: str = "label_date") -> DataFrame:
    """Users with rows on at least `min_days` different dates."""
    days = df.groupBy(user).agg(F.count_distinct(date).alias("active_days"))
    return days.where(F.col("active_days") >= min_days).select(user)


def capped_rating(rating: Column) -> Column:
    return F.least(rating, F.lit(MAX_RATING))


def item_family(item_id: Column) -> Column:
    """Item id without its two last digits, as BIGINT."""
    return F.call_function("div", item_id.cast("bigint"), F.lit(ITEM_ID_DIVISOR).cast("bigint"))


def stable_split(df: DataFrame, weights: Sequence[float], keys: Sequence[str]) -> list[DataFrame]:
    """Split by key hash in the given proportions; the same row always falls in the same part."""
    total = float(sum(weights))
    draw = stable_fraction(*[F.col(k) for k in keys])
    parts, low = [], 0.0
    for i, weight in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + weight / total
        parts.append(df.where((draw >= F.lit(low)) & (draw < F.lit(high))))
        low = high
    return parts


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 12345) -> list[DataFrame]:
    return df.randomSplit([float(w) for w in weights], seed)


def split_number(weights: Sequence[float], keys: Sequence[str]) -> Column:
    """The part of `stable_split` a row falls into, as a column."""
    total = float(sum(weights))
    draw = stable_fraction(*[F.col(k) for k in keys])
    number, high = F.lit(0), 0.0
    for weight in weights[:-1]:
        high += weight / total
        number = number + (draw >= F.lit(high)).cast("int")
    return number


def users_with_several(rows: DataFrame, user: str, counted: str, least: int = 2) -> DataFrame:
    """(user): the users with at least `least` non-null values of `counted`, by counts alone."""
    return rows.groupBy(user).agg(F.count(counted).alias("_n")).where(F.col("_n") >= least).select(user)


def join_ratings_with_users(
    ratings: DataFrame, users: DataFrame, user: str = "device_id", how: str = "inner", several: str | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Ratings with what is known of their users (one row for each). `several` names a column of which a user must have two
    non-null values at least: that needs counts only, so the ratings take part in a single join. `counts`, the
    `key_counts` of the ratings' users, lets hot users be split."""
    if several is not None:
        users = users.join(users_with_several(ratings, user, several), user)
        how = "inner" if how == "left" else how
    return skew_safe_join(ratings, users, [user], how, counts=counts)
