"""Feature stages of a ranking model from a plain description of the input columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.ml.feature import Bucketizer, VectorAssembler

from rankweave.models.stages import ColumnProduct, KeyValueExtractor, TagHasher, TagUnionHasher, ThresholdOneHot, ValueOneHot


@dataclass(frozen=True)
class TagUnion:
    """Several tag columns hashed into one vector."""

    columns: Sequence[str]
    top_ks: Sequence[int]
    filters: Sequence[bool]
    dim: int = 1000
    seed: int = 54321


@dataclass(frozen=True)
class FeatureSet:
    """Which columns become features, and how.

    `tags`, `positive_tags`: column -> vector size. `key_values`: `key:value` column -> allowed keys (one-hot).
    `one_hot`: column -> allowed values. `thresholds`: numeric column -> interval bounds (one-hot).
    `buckets`: numeric column -> inner splits (bucket number). `vectors`: ready vector columns. `numbers`: used as they
    are. `products`: new name -> columns described here that are multiplied out, by their first description, at any
    width; a bucket number counts as a category there, and ready vectors need the width in their metadata.
    """

    tags: Mapping[str, int] = field(default_factory=dict)
    positive_tags: Mapping[str, int] = field(default_factory=dict)
    unions: Mapping[str, TagUnion] = field(default_factory=dict)
    key_values: Mapping[str, Sequence[str]] = field(default_factory=dict)
    one_hot: Mapping[str, Sequence[str]] = field(default_factory=dict)
    thresholds: Mapping[str, Sequence[float]] = field(default_factory=dict)
    buckets: Mapping[str, Sequence[float]] = field(default_factory=dict)
    numbers: Sequence[str] = ()
    vectors: Sequence[str] = ()
    products: Mapping[str, Sequence[str]] = field(default_factory=dict)
    top_k: int = 100
    seed: int = 12345

    def stages(self, output: str = "features") -> list[Transformer]:
        """Transformers in order; the last one assembles the `output` vector."""
        made: list[Transformer] = []
        outputs: list[str] = []
        parts: dict[str, tuple[str, int]] = {}

        def use(name: str, column: str, width: int = 0) -> None:
            outputs.append(column)
            parts.setdefault(name, (column, width))

        def add(name: str, stage: Transformer, width: int = 0) -> None:
            made.append(stage)
            use(name, stage.getOutputCol(), width)

        for columns, positive in ((self.tags, False), (self.positive_tags, True)):
            for name, dim in columns.items():
                add(
                    name,
                    TagHasher(
                        inputCol=name, outputCol=f"{name}_vec", dim=dim, topK=self.top_k, seed=self.seed, filterPosTag=positive
                    ),
                )
        for name, union in self.unions.items():
            add(
                name,
                TagUnionHasher(
                    inputCols=list(union.columns),
                    outputCol=f"{name}_vec",
                    dim=union.dim,
                    topKs=list(union.top_ks),
                    filters=list(union.filters),
                    seed=union.seed,
                ),
            )
        for name, keys in self.key_values.items():
            made.append(KeyValueExtractor(inputCol=name, outputCol=f"{name}_key"))
            add(name, ValueOneHot(inputCol=f"{name}_key", outputCol=f"{name}_vec", values=list(keys)))
        for name, values in self.one_hot.items():
            add(name, ValueOneHot(inputCol=name, outputCol=f"{name}_vec", values=list(values)))
        for name, bounds in self.thresholds.items():
            add(name, ThresholdOneHot(inputCol=name, outputCol=f"{name}_vec", thresholds=list(bounds)))
        for name, splits in self.buckets.items():
            edges = [-float("inf"), *splits, float("inf")]
            add(name, Bucketizer(splits=edges, inputCol=name, outputCol=f"{name}_bucket", handleInvalid="keep"), -(len(splits) + 1))
        for name in (*self.numbers, *self.vectors):
            use(name, name)
        for name, factors in self.products.items():
            unknown = [f for f in factors if f not in parts]
            if unknown:
                raise ValueError(f"product {name!r} uses undescribed columns {unknown}")
            add(name, ColumnProduct(inputCols=[parts[f][0] for f in factors], widths=[parts[f][1] for f in factors], outputCol=f"{name}_vec"))
        if not outputs:
            raise ValueError("no features described")
        return [*made, VectorAssembler(inputCols=outputs, outputCol=output)]
