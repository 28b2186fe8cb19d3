"""Queries: cleaning, sampling, joins, sequences and profiles."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rankweave.functions.dates import shift_date
from rankweave.operators import cleaning, profile, sequences
from rankweave.operators.indexing import index_ids
from rankweave.plans import views
from rankweave.plans.catalog import query

KEY = ["event_id", "device_id", "feed_id", "label", "label_date"]

_BEST = """best AS (
  SELECT * FROM interactions
  QUALIFY row_number() OVER (PARTITION BY label_date, device_id, feed_id ORDER BY label DESC, ts, event_id) = 1)"""


def _best_label(spark, sf_dir):
    return cleaning.best_label(views.interactions(spark, sf_dir), [F.col("ts"), F.col("event_id")])


@query("best_label", f"WITH {views.INTERACTIONS}, {_BEST} SELECT event_id, device_id, feed_id, label, label_date FROM best")
def best_label(spark, sf_dir):
    return _best_label(spark, sf_dir).select(*KEY)


@query(
    "best_label_ties",
    f"""WITH {views.INTERACTIONS}
    SELECT event_id, device_id, feed_id, label, label_date FROM interactions
    QUALIFY label = max(label) OVER (PARTITION BY label_date, device_id, feed_id)""",
)
def best_label_ties(spark, sf_dir):
    return cleaning.best_label_join(views.interactions(spark, sf_dir).select(*KEY))


@query(
    "multi_record_users",
    f"""WITH {views.INTERACTIONS}
    SELECT event_id, device_id, feed_id, label, label_date FROM interactions
    QUALIFY count(feed_id) OVER (PARTITION BY device_id) > 1""",
)
def multi_record_users(spark, sf_dir):
    return cleaning.multi_record_users(views.interactions(spark, sf_dir).select(*KEY), salt_by=["event_id"])


@query(
    "active_users",
    f"""WITH {views.INTERACTIONS}
    SELECT device_id FROM interactions GROUP BY device_id HAVING count(DISTINCT label_date) >= 3""",
)
def active_users(spark, sf_dir):
    return cleaning.active_users(views.interactions(spark, sf_dir))


@query("label_split", f"WITH {views.INTERACTIONS} SELECT event_id, 'neg' AS side FROM interactions WHERE label = 0 UNION ALL SELECT event_id, 'pos' AS side FROM interactions WHERE label = 1")
def label_split(spark, sf_dir):
    rows = views.interactions(spark, sf_dir)
    return (
        cleaning.positives(rows)
        .select("event_id", F.lit("pos").alias("side"))
        .unionByName(cleaning.negatives(rows).select("event_id", F.lit("neg").alias("side")))
    )


_DRAW = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query(
    "negative_sampling",
    f"""WITH {views.INTERACTIONS}, ratio AS (
      SELECT least(1.0::DOUBLE, count(*) FILTER (label = 1) * 1.0::DOUBLE / count(*) FILTER (label = 0)) AS r
      FROM interactions)
    SELECT event_id, label FROM interactions, ratio WHERE label = 1 OR (label = 0 AND {_DRAW} < r)""",
)
def negative_sampling(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).select("event_id", "label")
    return cleaning.sample_negatives(rows, rate=1, keys=["event_id"])


@query(
    "train_test_split",
    f"WITH {views.INTERACTIONS} SELECT event_id, CASE WHEN {_DRAW} >= 0.8::DOUBLE THEN 1 ELSE 0 END AS part FROM interactions",
)
def train_test_split(spark, sf_dir):
    rows = views.interactions(spark, sf_dir)
    return rows.select("event_id", cleaning.split_number([0.8, 0.2], ["event_id"]).alias("part"))


@query(
    "fill_missing",
    f"""WITH {views.GAPPY}
    SELECT coalesce(event_type, 'null:0.0') AS event_type, coalesce(value, 0.0) AS value, label FROM gappy""",
)
def fill_missing(spark, sf_dir):
    rows = views.gappy_interactions(spark, sf_dir)
    return cleaning.fill_missing(cleaning.drop_id_columns(rows).drop("event_id")).select("event_type", "value", "label")


@query(
    "drop_incomplete",
    f"WITH {views.GAPPY} SELECT event_id, event_type, value FROM gappy WHERE event_type IS NOT NULL AND value IS NOT NULL",
)
def drop_incomplete(spark, sf_dir):
    return cleaning.drop_incomplete(views.gappy_interactions(spark, sf_dir).select("event_id", "event_type", "value"))


@query("distinct_rows", f"WITH {views.INTERACTIONS} SELECT DISTINCT device_id, feed_id, label FROM interactions")
def distinct_rows(spark, sf_dir):
    return views.interactions(spark, sf_dir).select("device_id", "feed_id", "label").dropDuplicates()


@query(
    "sampled_training_set",
    f"""WITH {views.INTERACTIONS}, kept AS (
      SELECT * FROM interactions QUALIFY count(feed_id) OVER (PARTITION BY device_id) > 1),
    ratio AS (SELECT least(1.0::DOUBLE, count(*) FILTER (label = 1) * 1.0::DOUBLE / count(*) FILTER (label = 0)) AS r FROM kept)
    SELECT event_id, device_id, feed_id, label, label_date FROM kept, ratio
    WHERE label = 1 OR (label = 0 AND {_DRAW} < r)""",
)
def sampled_training_set(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).select(*KEY)
    users = cleaning.multi_record_users(rows, salt_by=["event_id"])
    return cleaning.sample_negatives(users, rate=1, keys=["event_id"])


@query("rating_prep", f"WITH {views.RATINGS} SELECT device_id, item_id, family, rating FROM ratings")
def rating_prep(spark, sf_dir):
    return views.ratings(spark, sf_dir)


_LABEL_USERS = "label_users AS (SELECT device_id, count(*) AS positives FROM interactions WHERE label = 1 GROUP BY device_id)"


def _label_users(spark, sf_dir):
    positive = cleaning.positives(views.interactions(spark, sf_dir))
    return positive.groupBy("device_id").agg(F.count(F.lit(1)).alias("positives"))


@query(
    "rating_label_join",
    f"""WITH {views.INTERACTIONS}, {views.RATINGS}, {_LABEL_USERS}
    SELECT device_id, item_id, rating, positives FROM ratings JOIN label_users USING (device_id)
    QUALIFY count(item_id) OVER (PARTITION BY device_id) > 1""",
)
def rating_label_join(spark, sf_dir):
    rows = views.ratings(spark, sf_dir).select("device_id", "item_id", "rating")
    return cleaning.join_ratings_with_users(rows, _label_users(spark, sf_dir), several="item_id")


@query(
    "rating_label_left_join",
    f"""WITH {views.INTERACTIONS}, {views.RATINGS}, {_LABEL_USERS}
    SELECT device_id, item_id, rating, positives FROM ratings LEFT JOIN label_users USING (device_id)""",
)
def rating_label_left_join(spark, sf_dir):
    rows = views.ratings(spark, sf_dir).select("device_id", "item_id", "rating")
    return cleaning.join_ratings_with_users(rows, _label_users(spark, sf_dir), how="left")


@query(
    "user_sequences",
    f"""WITH {views.INTERACTIONS}
    SELECT device_id, 0::BIGINT AS part, string_agg(feed_id, ' ' ORDER BY ts, event_id) AS feeds
    FROM interactions WHERE label = 1 GROUP BY device_id HAVING count(*) > 1""",
)
def user_sequences(spark, sf_dir):
    return sequences.as_text(sequences.user_sequences(views.interactions(spark, sf_dir)), "feeds")


@query(
    "item_sequences",
    f"""WITH {views.INTERACTIONS}
    SELECT feed_id, 0::BIGINT AS part, string_agg(device_id, ' ' ORDER BY ts, event_id) AS users
    FROM interactions WHERE label = 1 GROUP BY feed_id HAVING count(*) > 1""",
)
def item_sequences(spark, sf_dir):
    return sequences.as_text(sequences.item_sequences(views.interactions(spark, sf_dir)), "users")


@query(
    "user_history",
    f"""WITH {views.INTERACTIONS}
    SELECT device_id, label_date AS dt, 0::BIGINT AS part, string_agg(feed_id, ' ' ORDER BY ts, event_id) AS feeds
    FROM interactions WHERE label = 1 GROUP BY device_id, label_date""",
)
def user_history(spark, sf_dir):
    rows = views.interactions(spark, sf_dir)
    return sequences.as_text(sequences.user_history(rows, F.col("label_date")), "feeds")


@query(
    "positive_lists",
    f"""WITH {views.INTERACTIONS}
    SELECT device_id, 0::BIGINT AS part, string_agg(feed_id, ' ' ORDER BY ts, event_id) AS label
    FROM interactions WHERE label = 1 GROUP BY device_id""",
)
def positive_lists(spark, sf_dir):
    return sequences.as_text(sequences.positive_lists(views.interactions(spark, sf_dir)), "label")


@query(
    "flagship_sequences",
    f"""WITH {views.INTERACTIONS}, {_BEST}, kept AS (
      SELECT * FROM best QUALIFY count(feed_id) OVER (PARTITION BY device_id) > 1)
    SELECT device_id, 0::BIGINT AS part, string_agg(feed_id, ' ' ORDER BY ts, event_id) AS feeds
    FROM kept WHERE label = 1 GROUP BY device_id HAVING count(*) > 1""",
)
def flagship_sequences(spark, sf_dir):
    """Best label per impression, users with several records, then the item sequence of each user."""
    raw = views.interactions(spark, sf_dir)
    order = [F.col("ts"), F.col("event_id")]
    rows = cleaning.best_label_of_repeat_users(raw.select(*KEY, "ts"), order, salt_by=["event_id"])
    return sequences.as_text(sequences.user_sequences(rows, sized_by=raw), "feeds")


@query(
    "ordered_positions",
    f"""WITH {views.INTERACTIONS}
    SELECT event_id, device_id, row_number() OVER (PARTITION BY device_id ORDER BY ts, event_id) - 1 AS position
    FROM interactions""",
)
def ordered_positions(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).select("event_id", "device_id", "ts")
    numbered = sequences.ordered_positions(
        rows, ["device_id"], ["ts", "event_id"], F.date_trunc("day", "ts"), "position"
    )
    return numbered.select("event_id", "device_id", "position")


@query(
    "shifted_dates",
    f"""WITH {views.INTERACTIONS}
    SELECT label_date, strftime(CAST(label_date AS DATE) - 1, '%Y-%m-%d') AS day_before,
           strftime(CAST(label_date AS DATE) + 7, '%Y-%m-%d') AS week_later, count(*) AS n
    FROM interactions GROUP BY label_date""",
)
def shifted_dates(spark, sf_dir):
    day = F.col("label_date")
    counted = views.interactions(spark, sf_dir).groupBy("label_date").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "label_date", shift_date(day, -1).alias("day_before"), shift_date(day, 7).alias("week_later"), "n"
    )


@query(
    "missing_rate",
    f"""WITH {views.GAPPY}, kept AS (SELECT event_type, value, feed_id, label FROM gappy),
    ratio AS (SELECT least(1.0::DOUBLE, count(*) FILTER (label = 1) * 3.0::DOUBLE / count(*) FILTER (label = 0)) AS r FROM gappy),
    sampled AS (SELECT * FROM gappy, ratio WHERE label = 1 OR (label = 0 AND {_DRAW} < r)),
    rates AS (
      SELECT 'event_type' AS c, label, avg(CASE WHEN event_type IS NULL OR event_type = '' THEN 1.0::DOUBLE ELSE 0 END) AS r FROM sampled GROUP BY label
      UNION ALL SELECT 'value', label, avg(CASE WHEN value IS NULL OR isnan(value) THEN 1.0::DOUBLE ELSE 0 END) FROM sampled GROUP BY label
      UNION ALL SELECT 'feed_id', label, avg(CASE WHEN feed_id IS NULL OR feed_id = '' THEN 1.0::DOUBLE ELSE 0 END) FROM sampled GROUP BY label)
    SELECT c AS "column", round(max(r) FILTER (label = 1), 6) AS positive_rate,
           round(max(r) FILTER (label = 0), 6) AS negative_rate FROM rates GROUP BY c""",
)
def missing_rate(spark, sf_dir):
    rows = cleaning.sample_negatives(views.gappy_interactions(spark, sf_dir), rate=3, keys=["event_id"])
    rates = profile.missing_rates(rows.select("event_type", "value", "feed_id", "label"))
    return rates.where(F.col("column") != "label").select(
        "column", F.round("positive_rate", 6).alias("positive_rate"), F.round("negative_rate", 6).alias("negative_rate")
    )


_DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


@query(
    "describe_table",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _DESCRIBED
    ),
)
def describe_table(spark, sf_dir):
    described = profile.describe_columns(views.table(spark, sf_dir, "lineitem"), _DESCRIBED)
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "vector_stats",
    f"""WITH {views.VECTORS}, cells AS (
      SELECT unnest(generate_series(0, {views.VECTOR_WIDTH - 1})) AS dim, unnest(vec) AS v FROM vectors)
    SELECT CAST(dim AS INTEGER) AS dim, round(min(v), 6) AS min, round(max(v), 6) AS max, round(avg(v), 6) AS mean,
           round(var_samp(v), 6) AS variance, count(*) FILTER (v <> 0) AS nonzeros FROM cells GROUP BY dim""",
)
def vector_stats(spark, sf_dir):
    rows = views.vectors(spark, sf_dir).select(array_to_vector("vec").alias("features"))
    return profile.vector_stats(rows, "features").withColumns(
        {c: F.round(c, 6) for c in ("min", "max", "mean", "variance")}
    )


@query(
    "distinct_counts",
    f"""WITH {views.INTERACTIONS}
    SELECT count(*) AS rows, count(DISTINCT device_id) AS distinct_device_id, count(DISTINCT feed_id) AS distinct_feed_id,
           count(DISTINCT label_date) AS distinct_label_date FROM interactions""",
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(views.interactions(spark, sf_dir), ["device_id", "feed_id", "label_date"])


@query(
    "group_counts",
    f"WITH {views.INTERACTIONS} SELECT device_id, label, count(*) AS n FROM interactions GROUP BY device_id, label",
)
def group_counts(spark, sf_dir):
    return views.interactions(spark, sf_dir).groupBy("device_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query("label_range", "SELECT min(l_quantity) AS min_target, max(l_quantity) AS max_target FROM lineitem")
def label_range(spark, sf_dir):
    return profile.label_range(views.table(spark, sf_dir, "lineitem"), "l_quantity")


@query(
    "index_ids",
    f"""WITH {views.INTERACTIONS}, ids AS (SELECT DISTINCT device_id FROM interactions)
    SELECT device_id, CAST(row_number() OVER (ORDER BY substr(md5(device_id), 1, 3), device_id) - 1 AS INTEGER) AS index
    FROM ids""",
)
def index_device_ids(spark, sf_dir):
    return index_ids(views.interactions(spark, sf_dir), "device_id", "index")
