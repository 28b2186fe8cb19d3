"""Embedding files (`date word v1 ... vn`), similar-word files, sequences and user histories as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.dates import vector_days
from rankweave.sources.logs import read_tsv
from rankweave.sources.schemas import HISTORY


def underscored(day: str) -> str:
    return day.replace("-", "_")


def read_vectors(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return parse_vectors(spark.read.text(list(paths)))


def parse_vectors(lines: DataFrame) -> DataFrame:
    """(id, dt, vec) of embedding lines; the date may be written with underscores."""
    parts = F.split("value", " ")
    return lines.select(
        parts[1].alias("id"),
        F.translate(parts[0], "_", "-").alias("dt"),
        F.transform(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), lambda v: v.cast("double")).alias(
            "vec"
        ),
    )


#: Fixed value: how files of embeddings are named in existing folders.
DAILY_FILE = "wordvec_{day}.txt"


def read_daily_vectors(spark: SparkSession, root: str, day: str, days: int, name: str = "train", file: str = DAILY_FILE) -> DataFrame:
    """Embeddings of the days in front of the rows they are joined to, from one file a day."""
    return read_vectors(spark, [f"{root}/{file.format(day=underscored(d))}" for d in vector_days(day, days, name)])


def format_vectors(vectors: DataFrame, day: str) -> DataFrame:
    """(id, vec) as embedding lines of one day."""
    numbers = F.array_join(F.transform("vec", lambda v: v.cast("string")), " ")
    return vectors.select(F.concat_ws(" ", F.lit(underscored(day)), F.col("id"), numbers).alias("value"))


def write_vectors(vectors: DataFrame, path: str, day: str) -> None:
    """(id, vec) as embedding lines of one day, in parallel files."""
    format_vectors(vectors, day).write.mode("overwrite").text(path)


def format_similar(similar: DataFrame) -> DataFrame:
    """Ranked (query_id, item_id, rank) rows as `word a,b,c` lines; each list is as short as the ranking."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "item_id")))
    lists = similar.groupBy("query_id").agg(F.transform(ordered, lambda e: e["item_id"]).alias("items"))
    line = F.concat_ws(" ", F.col("query_id"), F.array_join(F.col("items").cast("array<string>"), ","))
    return lists.select(line.alias("value"))


def write_similar(similar: DataFrame, path: str) -> None:
    format_similar(similar).write.mode("overwrite").text(path)


def format_sequences(sequences: DataFrame, column: str) -> DataFrame:
    """One blank-joined sequence per line."""
    return sequences.select(F.array_join(F.col(column).cast("array<string>"), " ").alias(column))


def write_sequences(sequences: DataFrame, column: str, path: str, single_file: bool = False) -> None:
    """One blank-joined sequence per line. A single file is possible for small data; the default writes in parallel."""
    lines = format_sequences(sequences, column)
    if single_file:
        lines = lines.coalesce(1)
    lines.write.mode("overwrite").option("sep", "\t").csv(path)


def format_history(history: DataFrame) -> DataFrame:
    """(device_id, feeds, dt) with the items joined by blanks."""
    return history.select("device_id", F.array_join(F.col("feeds").cast("array<string>"), " ").alias("feeds"), "dt")


def write_history(history: DataFrame, path: str) -> None:
    """(device_id, feeds, dt) as tab-separated files in a `dt=` folder per day; other days stay as they are."""
    format_history(history).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("sep", "\t").partitionBy("dt").csv(path)


def read_history(spark: SparkSession, root: str, day: str, days: int, name: str = "train") -> DataFrame:
    """(device_id, feeds, dt) of the days in front of the rows they are joined to."""
    paths = [f"{root}/dt={d}" for d in vector_days(day, days, name)]
    rows = read_tsv(spark, paths, HISTORY, base=root)
    return rows.withColumn("dt", F.col("dt").cast("string"))
