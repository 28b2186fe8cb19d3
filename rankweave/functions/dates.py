"""Dates are `yyyy-MM-dd` strings, as in the partition names of the feature logs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift_date(value: Column, days: int) -> Column:
    """A `yyyy-MM-dd` string moved by whole days."""
    return F.date_add(value.cast("date"), days).cast("string")


def shifted(day: str, days: int) -> str:
    """The same for one driver-side date."""
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def train_days(train_date: str, days: int) -> list[str]:
    """The training day and the `days` before it."""
    return [shifted(train_date, -i) for i in range(days + 1)]


def eval_days(eval_date: str, days: int) -> list[str]:
    """`days + 1` days, starting on the day after `eval_date`."""
    return [shifted(eval_date, i + 1) for i in range(days + 1)]


def realtime_eval_days(eval_date: str, days: int) -> list[str]:
    """`days + 1` days, starting on `eval_date` itself."""
    return [shifted(eval_date, i) for i in range(days + 1)]


def vector_days(day: str, days: int, name: str) -> list[str]:
    """Days of embeddings and histories: always one day behind the rows they are joined to."""
    if name == "train":
        return [shifted(day, -i) for i in range(1, days + 2)]
    return [shifted(day, i - 1) for i in range(days + 1)]
