"""Naming a computed value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`, which may use it several times.

    Inside higher-order functions Spark does not share common subexpressions, so an expression that is used twice at
    each of n levels would be evaluated 2^n times.
    """
    return F.transform(F.array(value), body)[0]
