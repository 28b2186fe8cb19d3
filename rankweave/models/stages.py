"""ML pipeline stages around the column expressions. Their settings are real params, so saved pipelines load again."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions import encode, tag_hash, tags
from rankweave.functions.vectors import outer_product, sparse_vector, vector_metadata, vector_of_slots


def _bool_list(value) -> list[bool]:
    return [TypeConverters.toBoolean(v) for v in value]


class _Stage(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A stage that appends one column computed from existing ones."""

    def _input_names(self) -> list[str]:
        raise NotImplementedError

    def _append(self, dataset: DataFrame, value: Column, metadata: dict | None = None) -> DataFrame:
        name = self.getOutputCol()
        missing = [c for c in self._input_names() if c not in dataset.columns]
        if missing:
            raise ValueError(f"input columns {missing} do not exist")
        if name in dataset.columns:
            raise ValueError(f"output column {name!r} already exists")
        return dataset.withColumn(name, value.alias(name, metadata=metadata) if metadata else value)

    def _append_slots(self, dataset: DataFrame, slots: Column, size: int) -> DataFrame:
        return self._append(dataset, sparse_vector(slots, size), vector_metadata(size))


class _OneInput(_Stage, HasInputCol):
    def _input_names(self) -> list[str]:
        return [self.getInputCol()]

    def _check_text(self, dataset: DataFrame) -> None:
        name = self.getInputCol()
        if name in dataset.columns and dict(dataset.dtypes)[name] != "string":
            raise TypeError(f"input column {name!r} must be a string, not {dict(dataset.dtypes)[name]}")


class TagHasher(_OneInput):
    """Tag string to sparse 0/1 vector of hashed terms."""

    dim = Param(Params._dummy(), "dim", "vector size", typeConverter=TypeConverters.toInt)
    topK = Param(Params._dummy(), "topK", "terms kept when filtering", typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "hash seed", typeConverter=TypeConverters.toInt)
    filterPosTag = Param(
        Params._dummy(), "filterPosTag", "keep the first topK non-negative tags only", typeConverter=TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, dim=1000, topK=100, seed=12345, filterPosTag=False):
        super().__init__()
        self._setDefault(dim=1000, topK=100, seed=12345, filterPosTag=False)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self._check_text(dataset)
        dim = self.getOrDefault(self.dim)
        slots = tag_hash.tag_hash_slots(
            F.col(self.getInputCol()),
            dim,
            self.getOrDefault(self.topK),
            self.getOrDefault(self.seed),
            self.getOrDefault(self.filterPosTag),
        )
        return self._append_slots(dataset, slots, dim)


class TagUnionHasher(_Stage, HasInputCols):
    """Several tag strings to one sparse 0/1 vector of the hashed union of their terms."""

    dim = Param(Params._dummy(), "dim", "vector size", typeConverter=TypeConverters.toInt)
    topKs = Param(Params._dummy(), "topKs", "terms kept per filtered column", typeConverter=TypeConverters.toListInt)
    filters = Param(Params._dummy(), "filters", "which columns drop negative tags", typeConverter=_bool_list)
    seed = Param(Params._dummy(), "seed", "hash seed", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, dim=1000, topKs=None, filters=None, seed=12345):
        super().__init__()
        self._setDefault(dim=1000, seed=12345)
        self._set(**self._input_kwargs)

    def _input_names(self) -> list[str]:
        return self.getInputCols()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dim = self.getOrDefault(self.dim)
        slots = tag_hash.union_tag_hash_slots(
            [F.col(c) for c in self.getInputCols()],
            self.getOrDefault(self.topKs),
            self.getOrDefault(self.filters),
            dim,
            self.getOrDefault(self.seed),
        )
        return self._append_slots(dataset, slots, dim)


class KeyValueExtractor(_OneInput):
    """Key (or value) of a `key:value` string as a number, -1 when there is none."""

    extractKey = Param(Params._dummy(), "extractKey", "key, else value", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, extractKey=True):
        super().__init__()
        self._setDefault(extractKey=True)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._append(dataset, tags.key_value_part(F.col(self.getInputCol()), self.getOrDefault(self.extractKey)))


class ValueOneHot(_OneInput):
    """Value to sparse 0/1 vector over a fixed list of values."""

    values = Param(Params._dummy(), "values", "ordered values", typeConverter=TypeConverters.toListString)
    mode = Param(Params._dummy(), "mode", "value|reference", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, values=None, mode="value"):
        super().__init__()
        self._setDefault(mode="value")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = self.getOrDefault(self.values)
        slots = encode.value_one_hot(F.col(self.getInputCol()), values, self.getOrDefault(self.mode))
        return self._append_slots(dataset, slots, len(values))


class ThresholdOneHot(_OneInput):
    """Number to sparse 0/1 vector of the interval it falls into."""

    thresholds = Param(Params._dummy(), "thresholds", "ordered bounds", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, thresholds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        thresholds = self.getOrDefault(self.thresholds)
        slots = encode.threshold_one_hot(F.col(self.getInputCol()), thresholds)
        return self._append_slots(dataset, slots, len(thresholds) - 1)


class ColumnProduct(_Stage, HasInputCols):
    """Outer product of vector, number and category columns as one sparse vector of any width.

    `widths` says for each input: the width of a vector (0: as its metadata has it), -k for a category 0 to k - 1; an
    input that is no vector and has 0 is a number.
    """

    widths = Param(Params._dummy(), "widths", "width of each input", typeConverter=TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, widths=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _input_names(self) -> list[str]:
        return self.getInputCols()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getInputCols()
        widths = self.getOrDefault(self.widths) if self.isDefined(self.widths) else [0] * len(names)
        if len(widths) != len(names):
            raise ValueError(f"{len(widths)} widths do not fit {len(names)} columns")
        fields = {f.name: f for f in dataset.schema.fields}
        for k, name in enumerate(names):
            if name in fields and isinstance(fields[name].dataType, VectorUDT) and widths[k] <= 0:
                widths[k] = fields[name].metadata.get("ml_attr", {}).get("num_attrs", 0)
                if widths[k] <= 0:
                    raise ValueError(f"give the width of {name!r}: its metadata does not say it")
        found, size = outer_product([F.col(c) for c in names], widths)
        return self._append(dataset, vector_of_slots(found, size), vector_metadata(size))


class LeafOneHot(_OneInput):
    """Leaf number per tree (vector or array) to sparse 0/1 vector with one active slot per tree."""

    trees = Param(Params._dummy(), "trees", "number of trees", typeConverter=TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "depth of the trees", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, trees=None, depth=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        leaves = F.col(self.getInputCol())
        if not dict(dataset.dtypes)[self.getInputCol()].startswith("array"):
            leaves = vector_to_array(leaves)
        depth = self.getOrDefault(self.depth)
        width = encode.leaf_width(self.getOrDefault(self.trees), depth)
        return self._append_slots(dataset, encode.leaf_one_hot(leaves, depth), width)
