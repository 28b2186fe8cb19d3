"""Scans of dated, tab-separated feature logs, rating files and label files.

Only the folders of the wanted days are listed and read. All scans stay lazy: columns and filters that a job does not
need are pruned, and nothing is counted on the way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.dates import eval_days, realtime_eval_days, shifted, train_days
from rankweave.operators.cleaning import (
    best_label,
    capped_rating,
    fill_missing,
    item_family,
    multi_record_users,
    sample_negatives,
)
from rankweave.sources.schemas import FEATURE_LOG


def read_tsv(spark: SparkSession, paths: Sequence[str], schema: T.StructType, base: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", "\t").option("header", "false")
    if base:
        reader = reader.option("basePath", base)
    return reader.csv(list(paths))


def parse_log(lines: DataFrame, schema: T.StructType = FEATURE_LOG) -> DataFrame:
    """Rows of tab-separated text lines (column `value`); empty fields are null."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("value", columns, {"sep": "\t"})
    return lines.select(row.alias("_row")).select("_row.*")


def format_log(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as tab-separated text lines (column `value`); nulls become empty fields."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def in_training_days(day: Column, train_day: Column, days: int = 7) -> Column:
    """Rows of the training day and the `days` before it. On a `dt` partition column only their folders are read."""
    return day.cast("date").between(F.date_sub(train_day.cast("date"), days), train_day.cast("date"))


def in_evaluation_days(day: Column, eval_day: Column, days: int = 1) -> Column:
    """Rows of the `days + 1` days from the day after `eval_day`."""
    return day.cast("date").between(F.date_add(eval_day.cast("date"), 1), F.date_add(eval_day.cast("date"), days + 1))


def in_realtime_evaluation_days(day: Column, eval_day: Column, days: int) -> Column:
    """Rows of `eval_day` itself and the `days` after it."""
    return day.cast("date").between(eval_day.cast("date"), F.date_add(eval_day.cast("date"), days))


def day_paths(root: str, days: Sequence[str], file_name: str = "") -> list[str]:
    """Partition folders `root/dt=<day>`, or one file in each."""
    return [f"{root}/dt={day}" + (f"/{file_name}" if file_name else "") for day in days]


def read_days(
    spark: SparkSession, root: str, days: Sequence[str], schema: T.StructType = FEATURE_LOG, file_name: str = ""
) -> DataFrame:
    return read_tsv(spark, day_paths(root, days, file_name), schema)


def training_log(
    spark: SparkSession, root: str, train_date: str, days: int = 7, schema: T.StructType = FEATURE_LOG, file_name: str = ""
) -> DataFrame:
    """The training day and the `days` before it."""
    return read_days(spark, root, train_days(train_date, days), schema, file_name)


def evaluation_log(
    spark: SparkSession, root: str, eval_date: str, days: int = 1, schema: T.StructType = FEATURE_LOG, file_name: str = ""
) -> DataFrame:
    """`days + 1` days from the day after `eval_date`."""
    return read_days(spark, root, eval_days(eval_date, days), schema, file_name)


def prepare_log(
    df: DataFrame, rate: float | None = 1, only_active: bool = False, keys: Sequence[str] | None = None
) -> DataFrame:
    """Optional restriction to users with several records, sampling of negatives, and filling of gaps.

    Pass rate=None for evaluation data: sampling it would change the metrics.
    """
    kept = multi_record_users(df) if only_active else df
    sampled = kept if rate is None else sample_negatives(kept, rate, keys)
    return fill_missing(sampled)


def realtime_log(
    spark: SparkSession,
    root: str,
    day: str,
    days: int,
    name: str = "train",
    schema: T.StructType = FEATURE_LOG,
    order: Sequence[str] = ("timestamp", "label_date", "r_source", "ctr_7", "feed_type"),
) -> DataFrame:
    """Hourly files `root/<day>/*/part-*`, reduced to the best label of each impression.

    Training reads `days` back from `day`, evaluation `days` forward from `day` itself. Columns of `order` settle which
    row stays among equal labels; without enough of them it would depend on the partitioning.
    """
    wanted = train_days(day, days) if name == "train" else realtime_eval_days(day, days)
    rows = read_tsv(spark, [f"{root}/{d}/*/part-*" for d in wanted], schema)
    return best_label(rows, [F.col(c) for c in order if c in schema.names])


def literal_rows(
    spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType = FEATURE_LOG
) -> DataFrame:
    """Rows given in code, with the full schema; absent columns are null."""
    values = [tuple(row.get(name) for name in schema.names) for row in rows]
    return spark.createDataFrame(values, schema)


def evaluation_rows(
    spark: SparkSession,
    source: str,
    root: str = "",
    eval_date: str = "",
    days: int = 1,
    rows: Sequence[Mapping[str, Any]] = (),
    schema: T.StructType = FEATURE_LOG,
) -> DataFrame:
    """Evaluation input from dated files (source="files") or from literal rows (source="rows")."""
    if source == "files":
        return evaluation_log(spark, root, eval_date, days, schema)
    if source == "rows":
        return literal_rows(spark, rows, schema)
    raise ValueError(f"unknown source {source!r}")


def read_ratings(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_ratings(spark.read.text(list(paths)))


def parse_ratings(lines: DataFrame) -> DataFrame:
    """(device_id, feed_id, rating) of `device::item::score` lines; item ids lose two digits, scores are capped."""
    parts = F.split("value", "::")
    return lines.select(
        parts[0].alias("device_id"),
        item_family(parts[1]).alias("feed_id"),
        capped_rating(parts[2].cast("double")).alias("rating"),
    )


def read_labels(
    spark: SparkSession, root: str, day: str, schema: T.StructType = FEATURE_LOG, file_name: str = ""
) -> DataFrame:
    """(device_id, feed_id, label) of the day after `day`."""
    return label_columns(read_days(spark, root, [shifted(day, 1)], schema, file_name))


def label_columns(rows: DataFrame) -> DataFrame:
    """(device_id, feed_id, label) of log rows; item ids lose two digits."""
    return rows.select("device_id", item_family(F.col("feed_id")).alias("feed_id"), "label")


def read_libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    """(label, features) of a LibSVM file; giving the number of features saves a pass over the data."""
    reader = spark.read.format("libsvm")
    if features is not None:
        reader = reader.option("numFeatures", str(features))
    return reader.load(path)
