"""The engine's inputs (interaction log, ratings, tags, vectors) as views over the given tables, with their SQL twins.

Every view covers its whole source table and stays lazy, so filters and column choices of a query reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.operators.cleaning import capped_rating, item_family

POSITIVE_EVENTS = ("click", "purchase")
VECTOR_WIDTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: device, feed item, 0/1 label, day, value."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("device_id"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("feed_id"),
        F.col("event_type").isin(*POSITIVE_EVENTS).cast("int").alias("label"),
        F.col("ts").cast("date").cast("string").alias("label_date"),
        "value",
        "event_type",
    )


INTERACTIONS = """interactions AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS device_id, regexp_extract(props, '([0-9]+)', 1) AS feed_id,
         CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS label,
         strftime(ts, '%Y-%m-%d') AS label_date, value, event_type
  FROM events)"""


def gappy_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions with missing event types and values, to exercise the handling of gaps."""
    return interactions(spark, sf_dir).select(
        "event_id",
        "device_id",
        "feed_id",
        "label",
        "label_date",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
    )


GAPPY = (
    INTERACTIONS
    + """, gappy AS (
  SELECT event_id, device_id, feed_id, label, label_date,
         CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
         CASE WHEN event_type <> 'view' THEN value END AS value
  FROM interactions)"""
)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(device_id, part, family, rating): ordered quantities as capped ratings."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("device_id"),
        F.col("l_partkey").alias("item_id"),
        item_family(F.col("l_partkey")).alias("family"),
        capped_rating(F.col("l_quantity")).alias("rating"),
    )


RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS device_id, l_partkey AS item_id, l_partkey // 100 AS family,
         least(l_quantity, 10.0) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag strings of each part, with some missing and empty ones, and a second tag column."""
    part = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    full = F.concat(
        words[0], F.lit(":"), (F.col("p_size") - 25).cast("string"), F.lit(","), words[1], F.lit(","), F.col("p_type")
    )
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("null:0.0"))
        .when(F.col("p_partkey") % 11 == 0, F.lit(""))
        .otherwise(full)
        .alias("tags"),
        F.concat(
            F.col("p_brand"), F.lit(":"), (F.col("p_size") % 3 - 1).cast("string"), F.lit(","), F.col("p_type")
        ).alias("brand_tags"),
        F.concat(F.col("p_size").cast("string"), F.lit(":"), F.col("p_retailprice").cast("string")).alias("size_price"),
        "p_brand",
        "p_type",
        "p_size",
        "p_retailprice",
    )


TAGS = """tags AS (
  SELECT p_partkey AS item_id,
         CASE WHEN p_partkey % 7 = 0 THEN 'null:0.0' WHEN p_partkey % 11 = 0 THEN ''
              ELSE string_split(p_name, ' ')[1] || ':' || (p_size - 25) || ',' || string_split(p_name, ' ')[2]
                   || ',' || p_type END AS tags,
         p_brand || ':' || (p_size % 3 - 1) || ',' || p_type AS brand_tags,
         p_size || ':' || p_retailprice AS size_price,
         p_brand, p_type, p_size, p_retailprice
  FROM part)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vec, label): embeddings as double arrays with a 0/1 label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        (F.col("label") % 2).alias("label"),
    )


VECTORS = """vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS vec, label % 2 AS label FROM embeddings)"""


def daily_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, dt, vec): one embedding per item and event day, different from day to day."""
    events = table(spark, sf_dir, "events")
    first = events.agg(F.min(F.col("ts").cast("date")).alias("d")).scalar()
    last = events.agg(F.max(F.col("ts").cast("date")).alias("d")).scalar()
    days = F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    by_day = vectors(spark, sf_dir).select("id", "vec", days.alias("day"))
    weight = lambda i: F.lit(1.0) + ((i + 1 + F.dayofmonth("day")) % 5) / F.lit(10.0)
    return by_day.select(
        "id", F.col("day").cast("string").alias("dt"), F.transform("vec", lambda v, i: v * weight(i)).alias("vec")
    )


DAILY_VECTORS = (
    VECTORS
    + """, days AS (
  SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS day FROM events),
daily_vectors AS (
  SELECT id, strftime(day, '%Y-%m-%d') AS dt,
         list_transform(vec, lambda v, i: v * (1.0::DOUBLE + ((i + day_no) % 5) / 10.0::DOUBLE)) AS vec
  FROM (SELECT id, vec, day, dayofmonth(day) AS day_no FROM vectors CROSS JOIN days))"""
)
