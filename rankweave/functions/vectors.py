"""Array arithmetic inside the JVM, and ML vectors from arrays of slots."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.binding import bind

def _vector_struct(size: int, cuts: pa.Array, indices: pa.Array, values: pa.Array, missing: pa.Array) -> pa.Array:
    """Sparse vectors as the struct behind the vector type; `cuts` are the offsets of the rows in both lists."""
    n = len(missing)
    parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), pa.ListArray.from_arrays(cuts, indices.cast(pa.int32())), pa.ListArray.from_arrays(cuts, values)]
    return pa.StructArray.from_arrays(parts, ["type", "size", "indices", "values"], mask=missing)


def _cuts(column: pa.Array) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy())).astype(np.int32))


def sparse_vector(indices: Column, size: int, values: Column | None = None) -> Column:
    """ML sparse vector from sorted distinct `indices`; every value is 1.0 unless `values` is given. Null indices give null.

    The vector type has no SQL constructor for sparse data, so whole columns are put together as Arrow buffers.
    """
    if values is None:

        @F.arrow_udf(VectorUDT())
        def ones(places: pa.Array) -> pa.Array:
            flat = places.flatten()
            return _vector_struct(size, _cuts(places), flat, pa.array(np.ones(len(flat))), places.is_null())

        return ones(indices)

    @F.arrow_udf(VectorUDT())
    def given(places: pa.Array, numbers: pa.Array) -> pa.Array:
        return _vector_struct(size, _cuts(places), places.flatten(), numbers.flatten().cast(pa.float64()), places.is_null())

    return given(indices, values)


def vector_of_slots(slots: Column, size: int) -> Column:
    """ML sparse vector from array<struct<i, v>> as `slot_values` has it.

    Its struct form is read back as JSON by the JVM: products are computed from vectors that Python made, and Spark does
    not take one Python function out of an expression over another one's result in every plan."""

    def body(pairs: Column) -> Column:
        return F.to_json(F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), pairs["i"].alias("indices"), pairs["v"].alias("values")))

    return F.from_json(F.concat(F.lit('{"v":'), bind(slots, body), F.lit("}")), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def vector_metadata(size: int) -> dict:
    """Column metadata that tells ML stages the vector width. Slots are not listed, so it has one size at any width."""
    return {"ml_attr": {"num_attrs": size}}


def slot_values(column: Column, width: int) -> Column:
    """The non-zero slots of a feature as array<struct<i int, v double>>, by slot.

    `width` says what the column is: an ML vector of that width; 0 a number, which has slot 0; -k a category 0 to k - 1,
    whose slot has the value 1. Other categories (null and NaN among them) have no slot, as a number null has none.
    """
    if width > 0:
        raw = F.unwrap_udt(column)
        places = F.when(raw["type"] == 0, raw["indices"]).otherwise(F.transform(raw["values"], lambda _, i: i))
        zipped = F.zip_with(places, raw["values"], lambda i, v: F.struct(i.alias("i"), v.alias("v")))
        return F.coalesce(F.filter(zipped, lambda e: e["v"] != 0.0), _no_slots())
    number = column.cast("double")
    if width == 0:
        return F.when(number != 0.0, F.array(F.struct(F.lit(0).alias("i"), number.alias("v")))).otherwise(_no_slots())
    inside = (number >= 0) & (number < -width) & (number == F.floor(number))
    return F.when(inside, F.array(F.struct(number.cast("int").alias("i"), F.lit(1.0).alias("v")))).otherwise(_no_slots())


def _no_slots() -> Column:
    return F.array().cast("array<struct<i: int, v: double>>")


def _multiplied(step: int) -> Callable[[Column], Column]:
    def product(both: Column) -> Column:
        def with_next(e: Column) -> Column:
            return F.transform(both["b"], lambda o: F.struct((e["i"] * step + o["i"]).alias("i"), (e["v"] * o["v"]).alias("v")))

        return F.flatten(F.transform(both["a"], with_next))

    return product


def outer_product(columns: Sequence[Column], widths: Sequence[int]) -> tuple[Column, int]:
    """(slots as by `slot_values`, width) of the product of several features: every combination of their slots, the last
    feature's slot running fastest. Only non-zero slots are multiplied, so the width costs nothing."""
    size = math.prod(max(abs(w), 1) for w in widths)
    if size > 2**31 - 1:
        raise ValueError(f"a product of {size} slots is wider than an ML vector can be")
    found = slot_values(columns[0], widths[0])
    for column, width in zip(columns[1:], widths[1:], strict=True):
        # Both sides are bound outside of the lambdas: an input that Python computes cannot stand inside of one.
        both = F.struct(found.alias("a"), slot_values(column, width).alias("b"))
        found = bind(both, _multiplied(max(abs(width), 1)))
    return found, size


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def magnitude(x: Column) -> Column:
    """Euclidean length, 1.0 for the zero vector so that it can be divided by."""
    squares = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)
    return bind(squares, lambda s: F.when(s == 0.0, F.lit(1.0)).otherwise(F.sqrt(s)))


def cosine_similarity(x: Column, y: Column) -> Column:
    """Cosine of two arrays of equal width; 0 when either is the zero vector."""
    checked = F.when(F.size(x) == F.size(y), dot(x, y)).otherwise(
        F.raise_error(F.lit("vectors differ in width")).cast("double")
    )
    return checked / (magnitude(x) * magnitude(y))


def normalized(x: Column) -> Column:
    """Vector of length one; the zero vector stays as it is."""
    return bind(magnitude(x), lambda m: F.transform(x, lambda v: v / m))


def zero_array(width: int) -> Column:
    return F.array_repeat(F.lit(0.0), width)
