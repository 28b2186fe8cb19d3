"""Queries: model scoring with given parameters, and model fits on whole tables with few iterations."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from rankweave.models import als, embeddings, ffm, ffm_table, fm, fm_table, parameter_blocks, skip_gram, tree_table, trees, tuning
from rankweave.operators import binary_eval, ranking_eval, sequences
from rankweave.plans import views
from rankweave.plans.catalog import query
from rankweave.session import cut_lineage

WIDTH = views.VECTOR_WIDTH
FACTORS = 4
FIELDS = 5


def _labelled(spark, sf_dir):
    """(id, features, label): embeddings as ML vectors."""
    rows = views.vectors(spark, sf_dir)
    return rows.select("id", "vec", array_to_vector("vec").alias("features"), "label")


def _formula_fm(task: str) -> fm.FMModel:
    """Parameters by formula, so that SQL can score with the same ones."""
    i, f = np.arange(WIDTH)[:, None], np.arange(FACTORS)[None, :]
    weights = ((np.arange(WIDTH) * 5) % 7 - 3) / 10.0
    factors = ((i * 7 + f * 3) % 11 - 5) / 10.0
    return fm.FMModel(0.1, weights, factors, task, -0.5, 0.5)


_FM_MARGIN = f"""{views.VECTORS}, cells AS (
  SELECT id, unnest(generate_series(0, {WIDTH - 1})) AS i, unnest(vec) AS x FROM vectors),
linear AS (SELECT id, sum(((i * 5) % 7 - 3) / 10.0::DOUBLE * x) AS l FROM cells GROUP BY id),
sums AS (
  SELECT id, f, sum(((i * 7 + f * 3) % 11 - 5) / 10.0::DOUBLE * x) AS s,
         sum((((i * 7 + f * 3) % 11 - 5) / 10.0::DOUBLE * x) ** 2) AS q
  FROM cells CROSS JOIN (SELECT unnest(generate_series(0, {FACTORS - 1})) AS f) GROUP BY id, f),
scored AS (
  SELECT id, 0.1::DOUBLE + any_value(l) + 0.5::DOUBLE * sum(s * s - q) AS margin FROM sums JOIN linear USING (id) GROUP BY id)"""


@query(
    "fm_score",
    f"""WITH {_FM_MARGIN}
    SELECT id, round(margin, 6) AS margin, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-margin)), 6) AS probability,
           round(greatest(-0.5::DOUBLE, least(0.5::DOUBLE, margin)), 6) AS clipped FROM scored""",
)
def fm_score(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    features = F.col("features")
    classifier, regressor = _formula_fm("classification"), _formula_fm("regression")
    return rows.select(
        "id",
        F.round(classifier.score(features, link=False), 6).alias("margin"),
        F.round(classifier.score(features), 6).alias("probability"),
        F.round(regressor.score(features), 6).alias("clipped"),
    )


@query("fm_score_table", f"WITH {_FM_MARGIN} SELECT id, round(margin, 6) AS margin FROM scored")
def fm_score_table(spark, sf_dir):
    """The same scores by joining with a parameter table, for models wider than one executor's memory."""
    model = _formula_fm("classification")
    table = spark.createDataFrame(
        [(j, float(model.weights[j]), [float(v) for v in model.factors[j]]) for j in range(WIDTH)],
        "feature long, w double, v array<double>",
    )
    scored = fm.score_with_table(_labelled(spark, sf_dir), "id", "features", table, model.intercept)
    return scored.select("id", F.round("margin", 6).alias("margin"))


def _nodes(vec):
    return F.transform(
        vec, lambda x, i: F.struct((i % FIELDS).cast("int").alias("f"), i.cast("int").alias("j"), x.alias("v"))
    )


def _formula_ffm() -> ffm.FFMModel:
    j, f, d = np.ogrid[:WIDTH, :FIELDS, :FACTORS]
    return ffm.FFMModel(((j * 7 + f * 5 + d * 3) % 13 - 6) / 10.0)


@query(
    "ffm_score",
    f"""WITH {views.VECTORS}, cells AS (
      SELECT id, unnest(generate_series(0, {WIDTH - 1})) AS j, unnest(vec) AS x FROM vectors)
    SELECT a.id, round(sum(2.0::DOUBLE * a.x * b.x * ((a.j * 7 + (b.j % {FIELDS}) * 5 + d * 3) % 13 - 6) / 10.0::DOUBLE
           * ((b.j * 7 + (a.j % {FIELDS}) * 5 + d * 3) % 13 - 6) / 10.0::DOUBLE), 6) AS margin
    FROM cells a JOIN cells b ON a.id = b.id AND a.j < b.j
         CROSS JOIN (SELECT unnest(generate_series(0, {FACTORS - 1})) AS d)
    GROUP BY a.id""",
)
def ffm_score(spark, sf_dir):
    rows = views.vectors(spark, sf_dir)
    return rows.select("id", F.round(_formula_ffm().score(_nodes(F.col("vec"))), 6).alias("margin"))


# Gradients of the mean loss at the formula parameters, with the regularisation (0.1, 0.01, 0.02).
_REG = (0.1, 0.01, 0.02)
_FM_GRADIENT = f"""{_FM_MARGIN}, slopes AS (
  SELECT id, CASE WHEN label = 1 THEN -1.0::DOUBLE / (1.0::DOUBLE + exp(margin)) ELSE 1.0::DOUBLE / (1.0::DOUBLE + exp(-margin)) END AS slope
  FROM scored JOIN vectors USING (id)),
gradients AS (
  SELECT 'intercept' AS kind, 0 AS factor, 0 AS feature, 0.1::DOUBLE AS value, avg(slope) + {_REG[0]} * 0.1::DOUBLE AS g FROM slopes
  UNION ALL
  SELECT 'weight', 0, i, ((i * 5) % 7 - 3) / 10.0::DOUBLE, sum(slope * x) / count(*) + {_REG[1]} * (((i * 5) % 7 - 3) / 10.0::DOUBLE)
  FROM cells JOIN slopes USING (id) GROUP BY i
  UNION ALL
  SELECT 'factor', f, i, ((i * 7 + f * 3) % 11 - 5) / 10.0::DOUBLE,
         sum(slope * x * (s - ((i * 7 + f * 3) % 11 - 5) / 10.0::DOUBLE * x)) / count(*) + {_REG[2]} * (((i * 7 + f * 3) % 11 - 5) / 10.0::DOUBLE)
  FROM cells JOIN slopes USING (id) JOIN sums USING (id) GROUP BY i, f)"""


def _blocks_as_rows(spark, blocks, column):
    """(kind, factor, feature, value) of one packed column of a block table."""
    packed = blocks.select("block", F.col(column).alias("x"))
    return fm_table.FMTable(packed, WIDTH, FACTORS).parameter_table()


@query(
    "fm_gradient_step",
    f"""WITH {_FM_GRADIENT}
    SELECT kind, CAST(factor AS INTEGER) AS factor, CAST(feature AS BIGINT) AS feature, round(g, 8) AS gradient FROM gradients""",
)
def fm_gradient_step(spark, sf_dir):
    """The gradient of all rows by every parameter, summed by block on the executors."""
    first = fm_table.FMTable.of(spark, _formula_fm("classification"))
    rows, _, _ = fm_table._deal(_labelled(spark, sf_dir), "features", "label", WIDTH, FACTORS, "classification", None)
    try:
        found = fm_table.Objective(rows, FACTORS, "classification", _REG).evaluate(first.blocks)[0]
    finally:
        rows.release()
    return _blocks_as_rows(spark, found, "g").select("kind", "factor", "feature", F.round("value", 8).alias("gradient"))


@query(
    "fm_sgd_step",
    f"""WITH {_FM_GRADIENT}
    SELECT kind, CAST(factor AS INTEGER) AS factor, CAST(feature AS BIGINT) AS feature, round(value - 0.5 * g, 8) AS value FROM gradients""",
)
def fm_sgd_step(spark, sf_dir):
    """Parameters after one step of gradient descent from the formula parameters."""
    first = fm_table.FMTable.of(spark, _formula_fm("classification"))
    rows = _labelled(spark, sf_dir)
    model = fm_table.train_sgd(rows, iterations=1, step_size=0.5, n_factors=FACTORS, n_features=WIDTH, reg=_REG, first=first)
    return model.parameter_table().withColumn("value", F.round("value", 8))


@query(
    "fm_lbfgs_step",
    f"""WITH {_FM_GRADIENT}
    SELECT kind, CAST(factor AS INTEGER) AS factor, CAST(feature AS BIGINT) AS feature,
           round(value - g / greatest(1.0::DOUBLE, sqrt((SELECT sum(g * g) FROM gradients))), 8) AS value FROM gradients""",
)
def fm_lbfgs_step(spark, sf_dir):
    """Parameters after the first step of vector-free L-BFGS, which has no history yet."""
    first = fm_table.FMTable.of(spark, _formula_fm("classification"))
    rows = _labelled(spark, sf_dir)
    model = fm_table.train_lbfgs(rows, iterations=1, n_factors=FACTORS, n_features=WIDTH, reg=_REG, first=first)
    return model.parameter_table().withColumn("value", F.round("value", 8))


def _ffm_weight(feature: str, field: str) -> str:
    return f"(({feature} * 7 + {field} * 5 + d * 3) % 13 - 6) / 10.0::DOUBLE"


@query(
    "ffm_gradient_step",
    f"""WITH {views.VECTORS}, cells AS (
      SELECT id, unnest(generate_series(0, {WIDTH - 1})) AS j, unnest(vec) AS x FROM vectors),
    factors AS (SELECT unnest(generate_series(0, {FACTORS - 1})) AS d),
    margins AS (
      SELECT a.id, sum(2.0::DOUBLE * a.x * b.x * {_ffm_weight('a.j', f'(b.j % {FIELDS})')} * {_ffm_weight('b.j', f'(a.j % {FIELDS})')}) AS margin
      FROM cells a JOIN cells b ON a.id = b.id AND a.j < b.j CROSS JOIN factors GROUP BY a.id),
    slopes AS (
      SELECT id, CASE WHEN label > 0 THEN -1.0::DOUBLE / (1.0::DOUBLE + exp(margin)) ELSE 1.0::DOUBLE / (1.0::DOUBLE + exp(-margin)) END AS slope
      FROM margins JOIN vectors USING (id))
    SELECT CAST(a.j AS BIGINT) AS feature, CAST(b.j % {FIELDS} AS INTEGER) AS field, CAST(d AS INTEGER) AS factor,
           round(sum(2.0::DOUBLE * slope * a.x * b.x * {_ffm_weight('b.j', f'(a.j % {FIELDS})')}) / (SELECT count(*) FROM vectors), 8) AS gradient
    FROM cells a JOIN cells b ON a.id = b.id AND a.j <> b.j JOIN slopes ON slopes.id = a.id CROSS JOIN factors
    GROUP BY a.j, b.j % {FIELDS}, d""",
)
def ffm_gradient_step(spark, sf_dir):
    """The gradient of all rows by every weight of the formula model, summed by block on the executors."""
    rows = views.vectors(spark, sf_dir).withColumn("nodes", _nodes(F.col("vec")))
    model = ffm_table.FFMTable.of(spark, _formula_ffm().weights)
    found = ffm_table.gradient(rows, model)[0]
    return ffm_table.cells(found, model, "g").select("feature", "field", "factor", F.round("value", 8).alias("gradient"))


def _scored(rows, score):
    return rows.select("id", "label", score.alias("score"))


@query("fm_sgd")
def fm_sgd(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    model = fm.train_sgd(rows, iterations=5, step_size=1.0, n_factors=FACTORS, n_features=WIDTH)
    return _scored(rows, model.score(F.col("features")))


@query("fm_lbfgs")
def fm_lbfgs(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    model = fm.train_lbfgs(rows, iterations=4, n_factors=FACTORS, n_features=WIDTH)
    return _scored(rows, model.score(F.col("features")))


@query("fm_regression")
def fm_regression(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    model = fm.train_sgd(rows, task="regression", iterations=3, n_factors=2, n_features=WIDTH)
    return _scored(rows, model.score(F.col("features")))


@query("ffm_fit")
def ffm_fit(spark, sf_dir):
    rows = views.vectors(spark, sf_dir).withColumn("nodes", _nodes(F.col("vec")))
    model = ffm.train(rows, FIELDS, WIDTH, n_factors=2, iterations=3)
    return _scored(rows, model.score(F.col("nodes"), link=True))


@query("fm_grid")
def fm_grid(spark, sf_dir):
    grid = {
        "iterations": (2, 3),
        "n_factors": (2,),
        "reg": ((0.0, 0.0, 0.1),),
        "corrections": (4,),
        "optimizer": ("sgd", "lbfgs"),
    }
    return tuning.search(_labelled(spark, sf_dir), ["id"], grid)


def _tree_features(spark, sf_dir):
    return _labelled(spark, sf_dir)


@query("gbt_fit_score")
def gbt_fit_score(spark, sf_dir):
    rows = _tree_features(spark, sf_dir)
    scored = trees.fit_trees(rows, rounds=3, depth=3).transform(rows)
    return scored.select(
        "id",
        "label",
        vector_to_array("predLeaf").alias("leaves"),
        vector_to_array("gbt_margin")[1].alias("margin"),
        vector_to_array("gbt_probability")[1].alias("probability"),
    )


#: A formula ensemble: five complete trees of depth 3, nodes numbered level by level.
_TREES, _INNER = 5, 7
_TREE_FEATURE = f"((t * 7 + n * 11) % {WIDTH})"
_TREE_CUT = "(((t * 5 + n * 3) % 7 - 3) / 20.0::DOUBLE)"


def _tree_step(level: int) -> str:
    return f"""level{level + 1} AS (
      SELECT id, vec, t, 2 * n + CASE WHEN vec[{_TREE_FEATURE} + 1] <= {_TREE_CUT} THEN 1 ELSE 2 END AS n FROM level{level})"""


@query(
    "tree_leaf_score",
    f"""WITH {views.VECTORS}, level0 AS (
      SELECT id, vec, t, 0 AS n FROM vectors CROSS JOIN (SELECT unnest(generate_series(0, {_TREES - 1})) AS t)),
    {_tree_step(0)}, {_tree_step(1)}, {_tree_step(2)},
    summed AS (
      SELECT id, string_agg(CAST(n - {_INNER} AS VARCHAR), ',' ORDER BY t) AS leaves,
             sum(CASE WHEN t = 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END * ((t * 3 + n) % 9 - 4) / 10.0::DOUBLE) AS margin
      FROM level3 GROUP BY id)
    SELECT id, leaves, round(margin, 6) AS margin, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-2 * margin)), 6) AS probability FROM summed""",
)
def tree_leaf_score(spark, sf_dir):
    """Leaves, margin and probability of an ensemble that is given as a table of nodes."""
    nodes = []
    for t in range(_TREES):
        for n in range(2 * _INNER + 1):
            inner = n < _INNER
            split = ((t * 7 + n * 11) % WIDTH, ((t * 5 + n * 3) % 7 - 3) / 20.0, None, 2 * n + 1, 2 * n + 2) if inner else (-1, None, None, -1, -1)
            nodes.append((t, 0.5 if t else 1.0, n, *split, ((t * 3 + n) % 9 - 4) / 10.0, -1 if inner else n - _INNER))
    ensemble = tree_table.TreeTable.of(spark.createDataFrame(nodes, tree_table.NODE_SCHEMA))
    scored = ensemble.score(_labelled(spark, sf_dir).select("id", "features")).select("id", "trees.*")
    return scored.select("id", F.array_join(F.col("leaves").cast("array<string>"), ",").alias("leaves"), F.round("margin", 6).alias("margin"), F.round("probability", 6).alias("probability"))


@query("tree_importance")
def tree_importance(spark, sf_dir):
    rows = _tree_features(spark, sf_dir)
    return trees.feature_importances(rows, trees.fit_trees(rows, rounds=3, depth=3))


@query("gbt_leaf_lr")
def gbt_leaf_lr(spark, sf_dir):
    rows = _tree_features(spark, sf_dir)
    model = trees.fit_leaf_lr(rows, rounds=3, depth=3, other_features=["features"], reg=0.01)
    trees.use_best_threshold(model.stages[-1])
    scored = model.transform(rows)
    return scored.select("id", "label", vector_to_array("probability")[1].alias("score"), "prediction")


@query("lr_objective")
def lr_objective(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    model = trees.logistic_regression(iterations=10, reg=0.01).fit(rows)
    return trees.training_summary(rows, model)


@query("lr_roc")
def lr_roc(spark, sf_dir):
    """The ROC curve of the training summary, its area, and the area of our own exact curve over the same scores."""
    rows = _labelled(spark, sf_dir)
    model = trees.logistic_regression(iterations=10, reg=0.01).fit(rows)
    scored = model.transform(rows).select("label", vector_to_array("probability")[1].alias("score"))
    return trees.training_roc(model).crossJoin(trees.training_area(rows, model)).crossJoin(binary_eval.areas(scored).select("auroc"))


@query("gbt_leaf_fm")
def gbt_leaf_fm(spark, sf_dir):
    rows = _tree_features(spark, sf_dir)
    pipeline, model = trees.fit_leaf_fm(
        rows, rounds=3, depth=3, other_features=["features"], iterations=3, n_factors=2, step_size=1.0
    )
    return model.transform(pipeline.transform(rows), "stack_features").select("id", "label", "probability", "prediction")


@query("stack_report")
def stack_report(spark, sf_dir):
    """Areas and weighted metrics of the tree-leaf stack, overall and on the slice of each label."""
    scored = cut_lineage(gbt_leaf_lr(spark, sf_dir))
    whole = binary_eval.areas(scored).select(F.lit("all").alias("slice"), "auroc", "aupr")
    report = binary_eval.classification_report(scored, groups=["label"])
    slices = report.select(F.concat(F.lit("label "), F.col("label")).alias("slice"), "accuracy", "weighted_f1")
    return whole.unionByName(slices, allowMissingColumns=True)


@query("indexed_gbt")
def indexed_gbt(spark, sf_dir):
    rows = _tree_features(spark, sf_dir).withColumn("label", F.concat(F.lit("class"), F.col("label")))
    scored = trees.fit_indexed_trees(rows, rounds=2).transform(rows)
    return scored.select("id", "label", "predictedLabel", "prediction", "indexedLabel")


def _als_ratings(spark, sf_dir):
    return views.ratings(spark, sf_dir).select("device_id", F.col("item_id").cast("string").alias("feed_id"), "rating")


@query("als_recommend")
def als_recommend(spark, sf_dir):
    return als.fit_als(_als_ratings(spark, sf_dir), iterations=2, reg=0.1).top_items(100)


@query("als_top_users")
def als_top_users(spark, sf_dir):
    return als.fit_als(_als_ratings(spark, sf_dir), iterations=2, reg=0.1).top_users(10)


@query("als_ranking_eval")
def als_ranking_eval(spark, sf_dir):
    """Ranking metrics of implicit recommendations against the items each device reacted to."""
    rows = views.interactions(spark, sf_dir)
    positive = rows.where(F.col("label") == 1)
    counts = positive.groupBy("device_id", "feed_id").agg(F.count(F.lit(1)).cast("double").alias("rating"))
    model = als.fit_als(counts, iterations=3, reg=0.1, implicit=True)
    labels = counts.groupBy("device_id").agg(F.sort_array(F.collect_list("feed_id")).alias("label"))
    lists = model.with_labels(labels, 100)
    return ranking_eval.ranking_metrics(lists, 10, 1000, prediction="recommendations")


@query("als_rmse")
def als_rmse(spark, sf_dir):
    tables, rows = als.indexed_ratings(_als_ratings(spark, sf_dir))
    predicted = als.fit_als(rows, iterations=3, reg=0.1, tables=tables).predict(rows)
    return binary_eval.rmse(predicted)


@query("als_rmse_search")
def als_rmse_search(spark, sf_dir):
    """The search by rating error over capped quantities as ratings, over the whole grid."""
    return als.cross_validate_rmse(_als_ratings(spark, sf_dir), implicit=False)


@query("als_cv")
def als_cv(spark, sf_dir):
    rows = views.interactions(spark, sf_dir).where(F.col("label") == 1)
    counts = rows.groupBy("device_id", "feed_id").agg(F.count(F.lit(1)).cast("double").alias("rating"))
    return als.cross_validate(counts, ranks=(2, 4), iterations=(2,), topN=20)


@query("word2vec_items")
def word2vec_items(spark, sf_dir):
    lists = sequences.user_sequences(views.interactions(spark, sf_dir))
    return embeddings.train_embeddings(lists, "feeds", width=16, min_count=1)


@query("word2vec_users")
def word2vec_users(spark, sf_dir):
    lists = sequences.item_sequences(views.interactions(spark, sf_dir))
    return embeddings.train_embeddings(lists, "users", width=16, min_count=1)


#: One round of skip-gram from formula vectors: 100 items, vectors of 4 numbers, a window of 2, 3 negatives.
_ITEMS, _DIMS, _NEGATIVES = 100, 4, 3
_OWN, _CONTEXT = "(((i * 7 + d * 3) % 11 - 5) / 10.0::DOUBLE)", "(((i * 5 + d * 2) % 13 - 6) / 10.0::DOUBLE)"


@query(
    "skip_gram_step",
    f"""WITH {views.INTERACTIONS}, placed AS (
      SELECT device_id, CAST(feed_id AS BIGINT) AS item, row_number() OVER (PARTITION BY device_id ORDER BY ts, event_id) AS at
      FROM interactions WHERE label = 1),
    pairs AS (
      SELECT row_number() OVER () AS p, a.item AS c, b.item AS o FROM placed a JOIN placed b
      ON a.device_id = b.device_id AND abs(a.at - b.at) BETWEEN 1 AND 2),
    targets AS (
      SELECT p, c, o AS t, 1 AS label FROM pairs
      UNION ALL SELECT p, c, (c * 7919 + o * 104729 + k * 1299709) % 2147483647 % {_ITEMS}, 0
      FROM pairs CROSS JOIN (SELECT unnest(generate_series(1, {_NEGATIVES})) AS k)),
    dims AS (SELECT unnest(generate_series(0, {_DIMS - 1})) AS d),
    cells AS (SELECT i, d, {_OWN} AS x, {_CONTEXT} AS y FROM (SELECT unnest(generate_series(0, {_ITEMS - 1})) AS i) CROSS JOIN dims),
    margins AS (SELECT a.i AS c, b.i AS t, sum(a.x * b.y) AS m FROM cells a JOIN cells b USING (d) GROUP BY a.i, b.i),
    slopes AS (SELECT p, c, t, 1.0::DOUBLE / (1.0::DOUBLE + exp(-m)) - label AS g FROM targets JOIN margins USING (c, t)),
    moved AS (
      SELECT 'item' AS kind, c AS i, d, sum(g * y) AS total, count(DISTINCT p) AS times FROM slopes JOIN cells ON t = i GROUP BY c, d
      UNION ALL SELECT 'context', t, d, sum(g * x), count(*) FROM slopes JOIN cells ON c = i GROUP BY t, d),
    before AS (SELECT 'item' AS kind, i, d, x AS value FROM cells UNION ALL SELECT 'context', i, d, y FROM cells)
    SELECT kind, i AS item, CAST(d AS INTEGER) AS place, round(value - coalesce(total / times, 0), 8) AS value
    FROM before LEFT JOIN moved USING (kind, i, d)""",
)
def skip_gram_step(spark, sf_dir):
    """All items' vectors after one round over the neighbours in the devices' positive sequences."""
    positions = sequences.item_positions(views.interactions(spark, sf_dir).where(F.col("label") == 1), ["device_id"], "feed_id")
    i, d = np.arange(_ITEMS)[:, None], np.arange(_DIMS)[None, :]
    vectors = np.concatenate([((i * 7 + d * 3) % 11 - 5) / 10.0, ((i * 5 + d * 2) % 13 - 6) / 10.0])
    first = parameter_blocks.blocks_of(spark, np.column_stack([vectors, np.zeros(2 * _ITEMS)]))
    pairs = skip_gram.neighbour_pairs(positions, ["device_id"], 2)
    model = skip_gram.train(pairs, _ITEMS, _DIMS, _NEGATIVES, rounds=1, first=first)
    found = [model.vectors(kind).select(F.lit(kind).alias("kind"), "item", F.posexplode("vec").alias("place", "value")) for kind in ("item", "context")]
    return found[0].union(found[1]).withColumn("value", F.round("value", 8))
