"""Queries: threshold curves, areas, classification reports and ranking metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.operators import binary_eval, ranking_eval, similarity
from rankweave.plans import views
from rankweave.plans.catalog import query

K = 10
N_ITEMS = 1000


def _scores(spark, sf_dir):
    """Event values as scores of the 0/1 label."""
    return views.interactions(spark, sf_dir).select("event_id", F.col("value").alias("score"), "label", "event_type")


_SCORES = f"{views.INTERACTIONS}, scores AS (SELECT event_id, value AS score, label, event_type FROM interactions)"

_TABLE = """counts AS (
  SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY score),
totals AS (SELECT sum(pos) AS p, sum(neg) AS n, count(*) AS scores FROM counts),
running AS (
  SELECT score, pos, neg, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, row_number() OVER w AS rank
  FROM counts WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""

_POINTS = """SELECT CAST(point AS BIGINT) AS point, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(coalesce(2.0::DOUBLE * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1,
  round(coalesce(1.25::DOUBLE * precision * recall / nullif(0.25::DOUBLE * precision + recall, 0), 0), 6) AS f05,
  round(fpr, 6) AS fpr
  FROM (SELECT point, threshold, tp, fp, tp / (tp + fp)::DOUBLE AS precision, tp / p::DOUBLE AS recall, fp / n::DOUBLE AS fpr
        FROM points, totals)"""

_ROUNDED = ("precision", "recall", "f1", "f05", "fpr")


@query(
    "threshold_curve",
    f"""WITH {_SCORES}, {_TABLE}, points AS (
      SELECT (rank - 1) // (scores // 10) + 1 AS point, min(score) AS threshold, max(cum_pos) AS tp, max(cum_neg) AS fp
      FROM running, totals GROUP BY 1) {_POINTS}""",
)
def threshold_curve(spark, sf_dir):
    curve = binary_eval.threshold_curve(_scores(spark, sf_dir), bins=10)
    return curve.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(
    "threshold_curve_full",
    f"""WITH {_SCORES}, {_TABLE}, points AS (
      SELECT rank AS point, score AS threshold, cum_pos AS tp, cum_neg AS fp FROM running) {_POINTS}""",
)
def threshold_curve_full(spark, sf_dir):
    curve = binary_eval.threshold_curve(_scores(spark, sf_dir), bins=0)
    return curve.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(
    "auc",
    f"""WITH {_SCORES}, {_TABLE}, ranked AS (
      SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM scores),
    pr AS (
      SELECT sum(pos * (precision + coalesce(before, precision)) / 2) AS area FROM (
        SELECT pos, rank, cum_pos / (cum_pos + cum_neg)::DOUBLE AS precision,
               lag(cum_pos / (cum_pos + cum_neg)::DOUBLE) OVER (ORDER BY rank) AS before FROM running))
    SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * n)::DOUBLE, 6) AS auroc,
           round(any_value(area) / p, 6) AS aupr, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives
    FROM ranked, totals, pr GROUP BY p, n""",
)
def auc(spark, sf_dir):
    found = binary_eval.areas(_scores(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in ("auroc", "aupr")})


@query(
    "best_threshold",
    f"""WITH {_SCORES}, {_TABLE}, f AS (
      SELECT score, 2.0::DOUBLE * cum_pos / (cum_pos + cum_neg + p) AS f1 FROM running, totals)
    SELECT round(max(f1), 6) AS max_f1, arg_max(score, round(f1, 12)) AS threshold FROM f""",
)
def best_threshold(spark, sf_dir):
    return binary_eval.best_threshold(_scores(spark, sf_dir)).withColumn("max_f1", F.round("max_f1", 6))


def _predictions(spark, sf_dir):
    return binary_eval.with_prediction(_scores(spark, sf_dir), "score", 20.0)


def _report_sql(group: str) -> str:
    """Weighted metrics of scores >= 20 against the label, per group (`''` for one group)."""
    key = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    on = f"USING ({group}, class)" if group else "USING (class)"
    return f"""WITH {_SCORES}, predicted AS (SELECT *, CASE WHEN score >= 20 THEN 1 ELSE 0 END AS prediction FROM scores),
    truth AS (SELECT {key}label AS class, count(*) AS t, count(*) FILTER (label = prediction) AS h FROM predicted GROUP BY {key}label),
    guesses AS (SELECT {key}prediction AS class, count(*) AS g FROM predicted GROUP BY {key}prediction),
    per_class AS (SELECT {key}t, h, coalesce(h / g::DOUBLE, 0) AS precision, h / t::DOUBLE AS recall FROM truth LEFT JOIN guesses {on})
    SELECT {key}CAST(sum(t) AS BIGINT) AS rows, round(sum(h) / sum(t), 6) AS accuracy,
           round(sum(t * precision) / sum(t), 6) AS weighted_precision, round(sum(t * recall) / sum(t), 6) AS weighted_recall,
           round(sum(t * coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)) / sum(t), 6) AS weighted_f1
    FROM per_class {by}"""


_REPORT = ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")


@query("weighted_f1", _report_sql(""))
def weighted_f1(spark, sf_dir):
    return binary_eval.classification_report(_predictions(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in _REPORT})


@query("slice_metrics", _report_sql("event_type"))
def slice_metrics(spark, sf_dir):
    """The report on one-class slices as well: every event type has a single label."""
    report = binary_eval.classification_report(_predictions(spark, sf_dir), groups=["event_type"])
    return report.withColumns({c: F.round(c, 6) for c in _REPORT})


@query(
    "slice_metrics_gaps",
    f"""WITH {views.GAPPY}, predicted AS (
      SELECT coalesce(event_type, '?') AS slice, label, CASE WHEN coalesce(value, 0) >= 20 THEN 1 ELSE 0 END AS prediction FROM gappy),
    truth AS (SELECT slice, label AS class, count(*) AS t, count(*) FILTER (label = prediction) AS h FROM predicted GROUP BY slice, label),
    guesses AS (SELECT slice, prediction AS class, count(*) AS g FROM predicted GROUP BY slice, prediction),
    per_class AS (SELECT slice, t, h, coalesce(h / g::DOUBLE, 0) AS precision, h / t::DOUBLE AS recall FROM truth LEFT JOIN guesses USING (slice, class))
    SELECT nullif(slice, '?') AS event_type, CAST(sum(t) AS BIGINT) AS rows, round(sum(h) / sum(t), 6) AS accuracy,
      round(sum(t * precision) / sum(t), 6) AS weighted_precision, round(sum(t * recall) / sum(t), 6) AS weighted_recall,
      round(sum(t * coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)) / sum(t), 6) AS weighted_f1
    FROM per_class GROUP BY slice""",
)
def slice_metrics_gaps(spark, sf_dir):
    """The report with a null slice."""
    rows = views.gappy_interactions(spark, sf_dir).withColumn("score", F.coalesce("value", F.lit(0.0)))
    report = binary_eval.classification_report(binary_eval.with_prediction(rows, "score", 20.0), groups=["event_type"])
    return report.withColumns({c: F.round(c, 6) for c in _REPORT})


@query(
    "accuracy",
    f"""WITH {_SCORES}, hit AS (SELECT CASE WHEN (score >= 20) = (label = 1) THEN 1.0::DOUBLE ELSE 0 END AS h FROM scores)
    SELECT round(avg(h), 6) AS accuracy, round(1 - avg(h), 6) AS error FROM hit""",
)
def accuracy(spark, sf_dir):
    return binary_eval.error_rate(_predictions(spark, sf_dir)).withColumns(
        {c: F.round(c, 6) for c in ("accuracy", "error")}
    )


@query(
    "rmse",
    """WITH means AS (SELECT l_partkey, avg(l_quantity) AS prediction FROM lineitem GROUP BY l_partkey)
    SELECT round(sqrt(avg((prediction - l_quantity) ** 2)), 6) AS rmse FROM lineitem JOIN means USING (l_partkey)""",
)
def rmse(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").alias("rating"))
    means = lines.groupBy("l_partkey").agg(F.avg("rating").alias("prediction"))
    return binary_eval.rmse(lines.join(means, "l_partkey")).withColumn("rmse", F.round("rmse", 6))


def ranking_lists(spark, sf_dir):
    """Per device and day: the 100 items with the highest value as prediction, all items with a positive as label.

    Rows are first reduced to one per device, day and item, so a list is never longer than the catalogue.
    """
    key = ["device_id", "label_date"]
    items = (
        views.interactions(spark, sf_dir)
        .groupBy(*key, "feed_id")
        .agg(F.max("value").alias("best"), F.max("label").alias("label"))
    )
    ranked = similarity.top_n(items, key, [F.col("best").desc(), F.col("feed_id")], 100)
    predicted = ranked.groupBy(*key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "feed_id"))), lambda e: e["feed_id"]).alias("prediction")
    )
    relevant = items.where(F.col("label") == 1).groupBy(*key).agg(F.sort_array(F.collect_list("feed_id")).alias("label"))
    empty = F.array().cast("array<string>")
    return predicted.join(relevant, key, "left").withColumn("label", F.coalesce("label", empty))


_LISTS = f"""{views.INTERACTIONS}, items AS (
  SELECT device_id, label_date, feed_id, max(value) AS best, max(label) AS label FROM interactions GROUP BY ALL),
pred AS (
  SELECT device_id, label_date, feed_id, label, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY device_id, label_date ORDER BY best DESC, feed_id) AS rank FROM items)
  WHERE rank <= 100),
rel AS (
  SELECT device_id, label_date, feed_id, row_number() OVER (PARTITION BY device_id, label_date ORDER BY feed_id) AS pos
  FROM items WHERE label = 1),
sizes AS (
  SELECT p.device_id, p.label_date, p.n AS n_pred, coalesce(r.n, 0) AS n_rel
  FROM (SELECT device_id, label_date, count(*) AS n FROM pred GROUP BY ALL) p
  LEFT JOIN (SELECT device_id, label_date, count(*) AS n FROM rel GROUP BY ALL) r USING (device_id, label_date)),
hits AS (
  SELECT device_id, label_date, rank, label, sum(label) OVER (PARTITION BY device_id, label_date ORDER BY rank) AS seen FROM pred),
gain AS (
  SELECT device_id, label_date, sum(CASE WHEN label = 1 THEN seen / rank::DOUBLE ELSE 0 END) AS ap,
         sum(CASE WHEN label = 1 AND rank <= {K} THEN 1 / ln(rank + 1) ELSE 0 END) AS dcg,
         sum(CASE WHEN label = 1 AND rank <= {K} THEN 1 ELSE 0 END) AS hits_k,
         sum(label) AS hits, min(CASE WHEN label = 1 THEN rank END) AS first_hit
  FROM hits GROUP BY ALL),
same AS (
  SELECT p.device_id, p.label_date, count(*) AS n FROM pred p JOIN rel r
    ON p.device_id = r.device_id AND p.label_date = r.label_date AND p.rank = r.pos AND p.feed_id = r.feed_id GROUP BY ALL),
metrics AS (
  SELECT CASE WHEN n_rel > 0 THEN ap / n_rel ELSE 0 END AS map,
         CASE WHEN n_rel > 0 THEN dcg / list_sum(list_transform(range(1, CAST(least(n_rel, greatest(n_pred, n_rel), {K}) AS BIGINT) + 1),
              lambda i: 1 / ln(i + 1))) ELSE 0 END AS ndcg,
         CASE WHEN n_rel > 0 THEN hits_k / {float(K)}::DOUBLE ELSE 0 END AS precision_k,
         hits / n_pred::DOUBLE AS overlap,
         CASE WHEN n_rel > 0 THEN hits_k / n_rel::DOUBLE END AS recall_k,
         coalesce(1.0::DOUBLE / first_hit, 0) AS mrr,
         CASE WHEN n_rel > 0 THEN coalesce(same.n, 0) / least(n_pred, n_rel)::DOUBLE END AS fcp
  FROM sizes JOIN gain USING (device_id, label_date) LEFT JOIN same USING (device_id, label_date)),
catalogue AS (
  SELECT (SELECT count(DISTINCT feed_id) FROM pred) / {float(N_ITEMS)}::DOUBLE AS diversity,
         (SELECT count(*) FROM (SELECT feed_id FROM pred UNION SELECT feed_id FROM rel)) / {float(N_ITEMS)}::DOUBLE AS max_diversity)"""

_LIST_METRIC_SQL = {
    "rank_map": ("map", "map"),
    "rank_ndcg": ("ndcg", "ndcgAt"),
    "rank_precision": ("precision_k", "precisionAtk"),
    "rank_overlap": ("overlap", "recallAtK"),
    "rank_recall": ("recall_k", "trueRecallAtK"),
    "rank_mrr": ("mrr", "mrr"),
    "rank_fcp": ("fcp", "fcp"),
}


def _register_list_metric(name: str, column: str, metric: str) -> None:
    @query(name, f"WITH {_LISTS} SELECT round(avg({column}), 6) AS value FROM metrics")
    def one_metric(spark, sf_dir):
        means = ranking_eval.ranking_metrics(ranking_lists(spark, sf_dir), K)
        return means.select(F.round(metric, 6).alias("value"))


for _name, (_column, _metric) in _LIST_METRIC_SQL.items():
    _register_list_metric(_name, _column, _metric)


@query("rank_diversity", f"WITH {_LISTS} SELECT round(diversity, 6) AS value FROM catalogue")
def rank_diversity(spark, sf_dir):
    found = ranking_eval.diversity(ranking_lists(spark, sf_dir), N_ITEMS)
    return found.select(F.round("diversityAtK", 6).alias("value"))


@query("rank_max_diversity", f"WITH {_LISTS} SELECT round(max_diversity, 6) AS value FROM catalogue")
def rank_max_diversity(spark, sf_dir):
    found = ranking_eval.max_diversity(ranking_lists(spark, sf_dir), N_ITEMS)
    return found.select(F.round("maxDiversity", 6).alias("value"))


@query(
    "rank_all",
    f"""WITH {_LISTS}
    SELECT round(avg(map), 6) AS map, round(avg(ndcg), 6) AS "ndcgAt", round(avg(precision_k), 6) AS "precisionAtk",
           round(avg(overlap), 6) AS "recallAtK", round(avg(recall_k), 6) AS "trueRecallAtK", round(avg(mrr), 6) AS mrr,
           round(avg(fcp), 6) AS fcp, round(any_value(diversity), 6) AS "diversityAtK",
           round(any_value(max_diversity), 6) AS "maxDiversity" FROM metrics, catalogue""",
)
def rank_all(spark, sf_dir):
    means = ranking_eval.ranking_metrics(ranking_lists(spark, sf_dir), K, N_ITEMS)
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@query(
    "rank_lists",
    f"""WITH {_LISTS}, labels_of AS (
      SELECT device_id, label_date, string_agg(feed_id, ' ' ORDER BY pos) AS label FROM rel GROUP BY ALL)
    SELECT p.device_id, p.label_date, string_agg(feed_id, ' ' ORDER BY rank) AS prediction, coalesce(any_value(l.label), '') AS label
    FROM pred p LEFT JOIN labels_of l USING (device_id, label_date) GROUP BY p.device_id, p.label_date""",
)
def rank_lists(spark, sf_dir):
    lists = ranking_lists(spark, sf_dir)
    return lists.select(
        "device_id",
        "label_date",
        F.array_join("prediction", " ").alias("prediction"),
        F.array_join("label", " ").alias("label"),
    )
