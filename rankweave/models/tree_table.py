"""Tree ensembles as a table of nodes: exported from fitted models, stored as Parquet, and walked inside the JVM."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.binding import bind

#: One row per node. A leaf has feature -1 and its ordinal in `leaf`; `categories` lists what goes near where a split is by
#: category and is null where it is by `cut` (near: at most the cut).
NODE_SCHEMA = "tree int, weight double, node int, feature int, cut double, categories array<double>, near int, far int, value double, leaf int"

_KEYS = ("feature", "cut", "categories", "near", "far", "value", "leaf", "weight")
_LITERAL = "array<struct<feature: int, cut: double, categories: array<double>, near: int, far: int, value: double, leaf: int, weight: double>>"


def export_trees(model, path: str, spark: SparkSession | None = None) -> DataFrame:
    """The node table of a fitted Spark tree model: a boosted or random ensemble, or a single tree.

    The model is saved under `path`, a folder that all executors share, and read back as a table; leaves are numbered in
    the order in which Spark reports them."""
    spark = spark or SparkSession.getActiveSession()
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" in data.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
        data = data.join(F.broadcast(weights), "treeID").select(F.col("treeID").alias("tree"), "weight", "nodeData.*")  # one row per tree
    else:
        data = data.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), "*")
    is_leaf = F.col("leftChild") < 0
    # Nodes are numbered depth first, near sides first, and so are leaves.
    leaves = data.groupBy("tree").agg(F.sort_array(F.collect_list(F.when(is_leaf, F.col("id")))).alias("_leaves"))
    rows = data.join(leaves, "tree")
    by_value = F.col("split.numCategories") < 0
    listed = F.col("split.leftCategoriesOrThreshold")
    return rows.select(
        "tree",
        "weight",
        F.col("id").alias("node"),
        F.when(is_leaf, -1).otherwise(F.col("split.featureIndex")).alias("feature"),
        F.when(~is_leaf & by_value, F.get(listed, F.lit(0))).alias("cut"),
        F.when(~is_leaf & ~by_value, listed).alias("categories"),
        F.col("leftChild").alias("near"),
        F.col("rightChild").alias("far"),
        F.col("prediction").alias("value"),
        F.when(is_leaf, F.array_position("_leaves", F.col("id")).cast("int") - 1).otherwise(-1).alias("leaf"),
    )


def write_trees(nodes: DataFrame, path: str) -> None:
    nodes.select(*[c.split()[0] for c in NODE_SCHEMA.split(", ")]).sort("tree", "node").write.mode("overwrite").parquet(path)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODE_SCHEMA).parquet(path)


@dataclass
class TreeTable:
    """An ensemble ready to score: its nodes as one foldable array, which travels with the plan. An ensemble has some
    hundred trees of some hundred nodes, whatever the data."""

    nodes: list[dict]
    roots: list[int]
    depth: int

    @classmethod
    def of(cls, table: DataFrame) -> TreeTable:
        rows = sorted((r.asDict() for r in table.collect()), key=lambda r: (r["tree"], r["node"]))
        place = {(r["tree"], r["node"]): k for k, r in enumerate(rows)}
        inner = {(r["tree"], n) for r in rows for n in (r["near"], r["far"]) if n >= 0}
        roots = [k for k, r in enumerate(rows) if (r["tree"], r["node"]) not in inner]
        if len(roots) != len({r["tree"] for r in rows}):
            raise ValueError("each tree needs exactly one node that no other leads to")
        nodes = [{k: r[k] for k in _KEYS} | {s: place[r["tree"], r[s]] if r[s] >= 0 else -1 for s in ("near", "far")} for r in rows]
        depth, level = 0, roots
        while level := [n for k in level for n in (nodes[k]["near"], nodes[k]["far"]) if n >= 0]:
            depth += 1
            if depth > len(nodes):
                raise ValueError("a tree leads back to one of its nodes")
        return cls(nodes, roots, depth)

    def _reached(self, features: Column, is_vector: bool) -> Column:
        """The leaf that each tree leads to, as an array of node structs: `depth` steps for every tree."""
        nodes = F.from_json(F.lit(json.dumps(self.nodes)), _LITERAL)
        roots = F.from_json(F.lit(json.dumps(self.roots)), "array<int>")

        def value(raw: Column, index: Column) -> Column:
            if not is_vector:
                return F.get(raw, index)
            place = F.array_position(raw["indices"], index)
            return F.when(raw["type"] == 1, F.get(raw["values"], index)).when(place > 0, F.get(raw["values"], place.cast("int") - 1)).otherwise(0.0)

        def step(raw: Column, at: Column) -> Column:
            def turn(n: Column) -> Column:
                x = value(raw, n["feature"])
                near = F.when(n["categories"].isNotNull(), F.array_contains(n["categories"], x)).otherwise(x <= n["cut"])
                # Null and NaN go far, as no number of them is at most the cut.
                return F.when(n["near"] < 0, at).when(F.coalesce(near, F.lit(False)), n["near"]).otherwise(n["far"])

            return bind(F.get(nodes, at), turn)

        if not self.depth:
            return F.transform(roots, lambda r: F.get(nodes, r))
        steps = F.sequence(F.lit(1), F.lit(self.depth))
        # Bound outside of the lambdas: features that Python computes cannot stand inside of one.
        held = F.unwrap_udt(features) if is_vector else features
        return bind(held, lambda raw: F.transform(roots, lambda r: F.get(nodes, F.aggregate(steps, r, lambda at, _: step(raw, at)))))

    def score(self, df: DataFrame, features: str = "features", output: str = "trees") -> DataFrame:
        """The rows with `output`, a struct of leaves (ordinals, one per tree), margin (the weighted sum of leaf values) and
        probability (the logistic of twice the margin). `features` is an ML vector or an array of doubles."""
        is_vector = not dict(df.dtypes)[features].startswith("array")
        reached = self._reached(F.col(features), is_vector)

        def described(leaves: Column) -> Column:
            margin = F.aggregate(leaves, F.lit(0.0), lambda total, n: total + n["weight"] * n["value"])
            return bind(margin, lambda m: F.struct(F.transform(leaves, lambda n: n["leaf"]).alias("leaves"), m.alias("margin"), (1.0 / (1.0 + F.exp(-2.0 * m))).alias("probability")))

        return df.withColumn(output, bind(reached, described))
