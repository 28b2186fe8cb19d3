"""Queries over the text formats: lines are written from the given tables and parsed back, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.operators import sequences
from rankweave.operators.similarity import history_items, top_n
from rankweave.plans import views
from rankweave.plans.catalog import query
from rankweave.sources import logs
from rankweave.sources import vectors as files
from rankweave.sources.schemas import SHORT_LOG

DAY = "2024-01-09"


@query(
    "log_lines",
    f"""WITH {views.INTERACTIONS}
SELECT device_id AS user_id, nullif(feed_id, '') AS feed_id, CAST(value AS DOUBLE) AS feature1, label AS feature2, label = 1 AS feature3
FROM interactions""",
)
def log_lines(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).withColumn("positive", F.col("label") == 1)
    return logs.parse_log(logs.format_log(rows, ["device_id", "feed_id", "value", "label", "positive"]), SHORT_LOG)


_LAST_DAY = "(SELECT max(CAST(label_date AS DATE)) FROM interactions)"


def _days(name: str, keep, condition: str) -> None:
    @query(name, f"WITH {views.INTERACTIONS} SELECT event_id, label_date FROM interactions WHERE CAST(label_date AS DATE) BETWEEN {condition}")
    def days(spark, sf_dir):
        rows = views.interactions(spark, sf_dir)
        last = rows.agg(F.max("label_date")).scalar()
        return rows.where(keep(F.col("label_date"), last)).select("event_id", "label_date")


_days("training_days", lambda day, last: logs.in_training_days(day, last, 7), f"{_LAST_DAY} - 7 AND {_LAST_DAY}")
_days("evaluation_days", lambda day, last: logs.in_evaluation_days(day, F.date_sub(last, 3), 1), f"{_LAST_DAY} - 2 AND {_LAST_DAY} - 1")
_days(
    "realtime_evaluation_days",
    lambda day, last: logs.in_realtime_evaluation_days(day, F.date_sub(last, 3), 2),
    f"{_LAST_DAY} - 3 AND {_LAST_DAY} - 1",
)


@query(
    "rating_lines",
    """SELECT CAST(o_custkey AS VARCHAR) AS device_id, l_partkey // 100 AS feed_id, least(CAST(l_quantity AS DOUBLE), 10.0::DOUBLE) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def rating_lines(spark, sf_dir):
    lines, orders = (views.table(spark, sf_dir, name) for name in ("lineitem", "orders"))
    fields = [F.col(c).cast("string") for c in ("o_custkey", "l_partkey", "l_quantity")]
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return logs.parse_ratings(joined.select(F.concat_ws("::", *fields).alias("value")))


@query(
    "label_columns",
    f"WITH {views.INTERACTIONS} SELECT device_id, CAST(nullif(feed_id, '') AS BIGINT) // 100 AS feed_id, label FROM interactions",
)
def label_columns(spark, sf_dir):
    return logs.label_columns(views.interactions(spark, sf_dir))


@query(
    "vector_lines",
    f"WITH {views.VECTORS} SELECT id, '{DAY}' AS dt, unnest(range(len(vec)))::INT AS place, unnest(vec) AS value FROM vectors",
)
def vector_lines(spark, sf_dir):
    parsed = files.parse_vectors(files.format_vectors(views.vectors(spark, sf_dir), DAY))
    return parsed.select("id", "dt", F.posexplode("vec").alias("place", "value"))


@query(
    "similar_lines",
    """SELECT query_id || ' ' || string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS value
FROM (SELECT p_brand AS query_id, p_partkey AS item_id, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part)
WHERE rank <= 5 GROUP BY query_id""",
)
def similar_lines(spark, sf_dir):
    part = views.table(spark, sf_dir, "part").select(F.col("p_brand").alias("query_id"), F.col("p_partkey").alias("item_id"), "p_retailprice")
    return files.format_similar(top_n(part, ["query_id"], [F.col("p_retailprice").desc(), F.col("item_id")], 5))


@query(
    "sequence_lines",
    f"""WITH {views.INTERACTIONS}
SELECT string_agg(feed_id, ' ' ORDER BY ts, event_id) AS feeds FROM interactions WHERE label = 1 GROUP BY device_id HAVING count(*) > 1""",
)
def sequence_lines(spark, sf_dir):
    return files.format_sequences(sequences.user_sequences(views.interactions(spark, sf_dir)), "feeds")


@query(
    "history_lines",
    f"WITH {views.INTERACTIONS} SELECT device_id, label_date AS dt, feed_id FROM interactions WHERE label = 1",
)
def history_lines(spark, sf_dir):
    """The check of the history format: joined by blanks, then split item by item."""
    history = sequences.user_history(views.interactions(spark, sf_dir), F.col("label_date"))
    return history_items(files.format_history(history))


_POSITIONS = f"""WITH {views.INTERACTIONS}, gaps AS (
  SELECT CASE WHEN event_id % 11 <> 0 THEN device_id END AS device_id, feed_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS ts, event_id
  FROM interactions WHERE label = 1)
SELECT device_id, row_number() OVER (PARTITION BY device_id ORDER BY ts NULLS FIRST, event_id) - 1 AS position, feed_id AS item FROM gaps"""


def _gappy_positives(spark, sf_dir):
    return views.interactions(spark, sf_dir).withColumns(
        {"device_id": F.when(F.col("event_id") % 11 != 0, F.col("device_id")), "ts": F.when(F.col("event_id") % 5 != 0, F.col("ts"))}
    )


@query("sequence_positions", _POSITIONS)
def sequence_positions(spark, sf_dir):
    """Items in order with missing times and users, through parts of three items."""
    lists = sequences.positive_lists(_gappy_positives(spark, sf_dir), part_size=3)
    return sequences.sequence_items(lists, ["device_id"], "label", 3)


@query("sequence_positions_whole", _POSITIONS)
def sequence_positions_whole(spark, sf_dir):
    """The same through whole lists."""
    return sequences.sequence_items(sequences.positive_lists(_gappy_positives(spark, sf_dir)), ["device_id"], "label")


@query("sequence_positions_long", _POSITIONS)
def sequence_positions_long(spark, sf_dir):
    """The same without any list."""
    rows = _gappy_positives(spark, sf_dir).where(F.col("label") == 1)
    return sequences.item_positions(rows, ["device_id"], "feed_id")
