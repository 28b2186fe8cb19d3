"""One-hot, bucket and column-splitting encodings as column expressions.

Encodings give the active slots as an array, so that they can be checked and joined as plain data;
`rankweave.functions.vectors.sparse_vector` turns them into ML vectors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _no_slots() -> Column:
    return F.array().cast("array<int>")


def value_one_hot(value: Column, values: Sequence[str], mode: str = "value", invalid: str = "zeros") -> Column:
    """Slot of `value` in the ordered list `values`, as array<int>; nothing dropped at the end.

    mode="value" compares as numbers where both sides are numbers ("1" equals "1.0"), else as text.
    mode="reference" compares text only and answers with slot 0 for every listed value.
    An unknown value has no slot, or fails with invalid="error".
    """
    text = value.cast("string")
    listed = F.array(*[F.lit(v) for v in values])
    if mode == "reference":
        slots = F.when(F.array_contains(listed, text), F.array(F.lit(0)))
    elif mode == "value":
        canonical = [_number_or_text(v) for v in values]
        number = text.try_cast("double")
        numbers = F.array(*[F.lit(c if isinstance(c, float) else None).cast("double") for c in canonical])
        position = F.when(number.isNotNull(), F.array_position(numbers, number)).otherwise(
            F.array_position(listed, text)
        )
        slots = F.when(position > 0, F.array((position - 1).cast("int")))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if invalid == "error":
        return F.coalesce(slots, F.raise_error(F.concat(F.lit("unknown value "), text)).cast("array<int>"))
    return F.coalesce(slots, _no_slots())


def _number_or_text(value: str) -> float | str:
    try:
        return float(value)
    except ValueError:
        return value


def label_one_hot(value: Column, labels: Sequence[str], invalid: str = "error") -> Column:
    """Slot of a label in an ordered list, compared as text; an unknown label fails or gives no slot."""
    text = value.cast("string")
    position = F.array_position(F.array(*[F.lit(v) for v in labels]), text)
    slots = F.when(position > 0, F.array((position - 1).cast("int")))
    if invalid == "error":
        return F.coalesce(slots, F.raise_error(F.concat(F.lit("unknown label "), text)).cast("array<int>"))
    return F.coalesce(slots, _no_slots())


def threshold_one_hot(value: Column, thresholds: Sequence[float]) -> Column:
    """Slot (number of thresholds <= value) - 1 of `len(thresholds) - 1` slots; none outside of them."""
    reached = F.lit(0)
    for threshold in thresholds:
        reached = reached + (value >= F.lit(float(threshold))).cast("int")
    slot = reached - 1
    return F.when((slot >= 0) & (slot < len(thresholds) - 1), F.array(slot)).otherwise(_no_slots())


def leaf_one_hot(leaves: Column, depth: int) -> Column:
    """Slot of each tree's leaf: leaf id + tree number * 2^(depth+1), as array<int>."""
    stride = 2 ** (depth + 1)
    return F.transform(leaves, lambda leaf, tree: leaf.cast("int") + tree * F.lit(stride))


def leaf_width(trees: int, depth: int) -> int:
    return trees * 2 ** (depth + 1)


def bucket_index(value: Column, splits: Sequence[float]) -> Column:
    """Bucket number of a value over inner `splits`, open to infinity on both sides; null stays null."""
    index = F.lit(0)
    for split in splits:
        index = index + (value >= F.lit(float(split))).cast("int")
    return F.when(value.isNotNull(), index)


def split_columns(
    df: DataFrame, column: str, width: int, separator: str = ",", prefix: str = "col_"
) -> tuple[DataFrame, list[str]]:
    """Append `width` columns with the parts of a string column; a missing part is null."""
    names = [f"{prefix}{i}" for i in range(width)]
    parts = F.split(F.col(column), separator)
    return df.select("*", *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]), names


def max_parts(df: DataFrame, column: str, separator: str = ",") -> int:
    """Widest row of a string column, for `split_columns`."""
    row = df.agg(F.max(F.size(F.split(F.col(column), separator))).alias("n")).first()
    return row["n"] or 0
