"""Collaborative filtering recall: alternating least squares over string ids, and its ranking evaluation."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.operators.indexing import index_ids, with_index
from rankweave.operators.naming import name_lists
from rankweave.operators.ranking_eval import RankingMetricsEvaluator
from rankweave.operators.similarity import top_lists_by_dot
from rankweave.session import cut_lineage, ensure_checkpoint_dir

#: Length of the recommendation list per user.
TOP_ITEMS = 100

#: Ratings over the cube of the number of blocks on each side, see `factor_blocks`.
RATINGS_A_CUBE = 1_000


@dataclass
class Recommender:
    """A fitted factor model with the mapping between string ids and factor rows."""

    model: ALSModel
    users: DataFrame
    items: DataFrame
    user_column: str
    item_column: str

    def _lists(self, own_name: str, other_name: str, n: int) -> DataFrame:
        """(own name, names, scores): the best `n` of the other side for each of the own side, with names for numbers. Every
        popular item is in most lists, so they are not joined by item."""
        tables = {self.user_column: (self.users, self.model.userFactors), self.item_column: (self.items, self.model.itemFactors)}
        (own, queries), (other, found) = tables[own_name], tables[other_name]
        vectors = [factors.select("id", F.col("features").alias("vec")) for factors in (queries, found)]
        lists = top_lists_by_dot(*vectors, n).join(own.select(F.col(own_name), F.col(f"{own_name}_index").alias("query_id")), "query_id")
        names = other.select(F.col(f"{other_name}_index").alias("id"), F.col(other_name).alias("name"))
        short = lists.select(own_name, "query_id", "ids", F.col("scores").cast("array<float>").alias("scores"))
        return name_lists(short, names, "query_id").select(own_name, "names", "scores")

    def _rows(self, named: DataFrame, own_name: str, other_name: str) -> DataFrame:
        pairs = named.select(own_name, F.posexplode(F.arrays_zip("names", "scores")).alias("rank", "r"))
        return pairs.select(own_name, F.col("r.names").alias(other_name), F.col("r.scores").alias("score"), (F.col("rank") + 1).alias("rank"))

    def _item_lists(self, n: int) -> DataFrame:
        return self._lists(self.user_column, self.item_column, n)

    def top_items(self, n: int = TOP_ITEMS) -> DataFrame:
        """(user, item, score, rank): the best `n` items of every user, by exact products of factors."""
        return self._rows(self._item_lists(n), self.user_column, self.item_column)

    def top_users(self, n: int = TOP_ITEMS) -> DataFrame:
        return self._rows(self._lists(self.item_column, self.user_column, n), self.item_column, self.user_column)

    def recommendation_lists(self, n: int = TOP_ITEMS) -> DataFrame:
        """(user, recommendations): ordered item lists of at most `n`."""
        return self._item_lists(n).select(self.user_column, F.col("names").alias("recommendations"))

    def with_labels(self, labels: DataFrame, n: int = TOP_ITEMS) -> DataFrame:
        """Recommendation lists next to the distinct label lists (user, label) of the same users."""
        known = labels.select(self.user_column, "label").dropDuplicates()
        joined = self.recommendation_lists(n).join(known, self.user_column).na.drop()
        return joined.select("recommendations", "label").dropDuplicates()

    def predict(self, pairs: DataFrame) -> DataFrame:
        """`pairs` with a `prediction`; pairs with an unknown user or item are left out. Factors are joined to the names, so
        that pairs meet each side once."""
        sides = ((self.user_column, self.users, self.model.userFactors), (self.item_column, self.items, self.model.itemFactors))
        indexes = [f"{column}_index" for column, _, _ in sides]
        ready = set(indexes) <= set(pairs.columns)
        found = pairs
        for (column, names, factors), index in zip(sides, indexes, strict=True):
            table = factors.select(F.col("id").alias(index), F.col("features").alias(f"_{index}"))
            found = found.join(table, index) if ready else found.join(names.join(table, index).drop(index), column)
        products = F.zip_with(*[F.col(f"_{index}").cast("array<double>") for index in indexes], lambda a, b: a * b)
        prediction = F.aggregate(products, F.lit(0.0), lambda total, v: total + v).cast("float")
        return found.select(*[c for c in pairs.columns if c not in indexes], prediction.alias("prediction"))


def index_tables(ratings: DataFrame, user: str = "device_id", item: str = "feed_id") -> tuple[DataFrame, DataFrame]:
    """Integer ids of users and items, as fitting needs them.

    Ids are numbered in parallel instead of through a label array on the driver. The tables are written to the
    checkpoint folder, since fitting and scoring must see the same numbers.
    """
    return (
        cut_lineage(index_ids(ratings, user, f"{user}_index")),
        cut_lineage(index_ids(ratings, item, f"{item}_index")),
    )


def indexed_ratings(ratings: DataFrame, user: str = "device_id", item: str = "feed_id", rating: str | None = "rating", tables: tuple[DataFrame, DataFrame] | None = None) -> tuple[tuple[DataFrame, DataFrame], DataFrame]:
    """The index tables, given or built, and the rows as (user index, item index, rating), written to the checkpoint folder:
    fitting reads its rows twice, and whoever scores the same rows need not join the names again."""
    value = F.col(rating).cast("float") if rating else F.lit(1.0).cast("float")
    rows = ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull()).select(user, item, value.alias("rating"))
    # Numbering and the joins read the rows; whatever they come from is computed once.
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        users, items = tables = tables or index_tables(rows, user, item)
        joined = with_index(with_index(rows, users, user), items, item)
        return tables, cut_lineage(joined.select(f"{user}_index", f"{item}_index", "rating"))
    finally:
        rows.unpersist()


def factor_blocks(ratings: int, parallelism: int) -> int:
    """Blocks of users, and of items, for so many ratings.

    A task that builds a block holds all its ratings, some 50 bytes for each; with as many blocks as cores that grows with the
    input. A task that deals ratings out holds a buffer of 24 KB for each pair of blocks. By the cube root both stay small:
    3,600,000 ratings a block and 86 MB of buffers for 216 million ratings.
    """
    return max(10, parallelism, round((ratings / RATINGS_A_CUBE) ** (1 / 3)))


def fit_als(
    ratings: DataFrame,
    user: str = "device_id",
    item: str = "feed_id",
    rating: str | None = "rating",
    rank: int = 5,
    iterations: int = 10,
    reg: float = 1.0,
    alpha: float = 1.0,
    implicit: bool = False,
    nonnegative: bool = False,
    blocks: int | None = None,
    seed: int = 12345,
    tables: tuple[DataFrame, DataFrame] | None = None,
) -> Recommender:
    """Factorise (user, item, rating) rows; without `rating` every row counts 1.

    `tables` are the `index_tables` of these or of more ratings; rows that already carry both index columns are used
    as they are. `blocks` of users and of items are factorised side by side; the default follows the session's cores and the
    number of ratings, which is counted for it.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    indexes = [f"{user}_index", f"{item}_index"]
    ready = set(indexes) <= set(ratings.columns)
    if ready:
        value = F.col(rating).cast("float") if rating else F.lit(1.0).cast("float")
        indexed = ratings.where(F.col(indexes[0]).isNotNull() & F.col(indexes[1]).isNotNull()).select(*indexes, value.alias("rating"))
        users, items = tables or index_tables(ratings, user, item)
    else:
        (users, items), indexed = indexed_ratings(ratings, user, item, rating, tables)
    blocks = blocks or factor_blocks(indexed.count(), ratings.sparkSession.sparkContext.defaultParallelism)
    als = ALS(
        userCol=indexes[0],
        itemCol=indexes[1],
        ratingCol="rating",
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        alpha=alpha,
        implicitPrefs=implicit,
        nonnegative=nonnegative,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        coldStartStrategy="drop",
        seed=seed,
    )
    model = als.fit(indexed)
    return Recommender(model, users, items, user, item)


class ALSRecommender(Estimator, HasLabelCol):
    """`fit_als` as an estimator, so that cross validation can search its parameters.

    The fitted model turns a table of (user, item[, label list]) into (recommendations, label): held-out items of each
    user are the label unless the table brings its own label column.
    """

    userCol = Param(Params._dummy(), "userCol", "user id", typeConverter=TypeConverters.toString)
    itemCol = Param(Params._dummy(), "itemCol", "item id", typeConverter=TypeConverters.toString)
    ratingCol = Param(Params._dummy(), "ratingCol", "rating, empty for 1", typeConverter=TypeConverters.toString)
    rank = Param(Params._dummy(), "rank", "number of factors", typeConverter=TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", typeConverter=TypeConverters.toInt)
    regParam = Param(Params._dummy(), "regParam", "regularisation", typeConverter=TypeConverters.toFloat)
    implicitPrefs = Param(Params._dummy(), "implicitPrefs", "implicit feedback", typeConverter=TypeConverters.toBoolean)
    topN = Param(Params._dummy(), "topN", "list length", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        userCol="device_id",
        itemCol="feed_id",
        ratingCol="rating",
        labelCol="label",
        rank=5,
        maxIter=5,
        regParam=0.1,
        implicitPrefs=True,
        topN=TOP_ITEMS,
    ):
        super().__init__()
        #: Index tables shared by all fits of a search; None builds them in each fit.
        self.tables: tuple[DataFrame, DataFrame] | None = None
        self._setDefault(
            userCol="device_id",
            itemCol="feed_id",
            ratingCol="rating",
            rank=5,
            maxIter=5,
            regParam=0.1,
            implicitPrefs=True,
            topN=TOP_ITEMS,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ALSRecommenderModel:
        found = fit_als(
            dataset,
            self.getOrDefault(self.userCol),
            self.getOrDefault(self.itemCol),
            self.getOrDefault(self.ratingCol) or None,
            rank=self.getOrDefault(self.rank),
            iterations=self.getOrDefault(self.maxIter),
            reg=self.getOrDefault(self.regParam),
            implicit=self.getOrDefault(self.implicitPrefs),
            tables=self.tables,
        )
        return ALSRecommenderModel(found, self.getLabelCol(), self.getOrDefault(self.topN))


class ALSRecommenderModel(Model):
    def __init__(self, recommender: Recommender, label_column: str, top_n: int):
        super().__init__()
        self.recommender = recommender
        self.label_column = label_column
        self.top_n = top_n

    def _transform(self, dataset: DataFrame) -> DataFrame:
        user, item = self.recommender.user_column, self.recommender.item_column
        if self.label_column in dataset.columns:
            labels = dataset.select(user, F.col(self.label_column).alias("label"))
        else:
            # One entry per distinct item: a list is never longer than the catalogue.
            pairs = dataset.select(user, item).distinct()
            labels = pairs.groupBy(user).agg(F.sort_array(F.collect_list(item)).alias("label"))
        return self.recommender.with_labels(labels, self.top_n)


#: Settings fitted side by side by `cross_validate_rmse`, and the ratings that they may have together.
SIDE_BY_SIDE, SIDE_RATINGS = 4, 4_000_000

#: The grid searched by default.
RANKS = (5, 10, 15, 20)
ITERATIONS = (5, 10, 20, 30, 50)


def cross_validate(
    ratings: DataFrame,
    ranks=RANKS,
    iterations=ITERATIONS,
    folds: int = 2,
    metric: str = "precisionAtk",
    top_k: int = 10,
    seed: int = 12345,
    **options,
) -> DataFrame:
    """(rank, iterations, score): mean held-out ranking metric of each setting, best first.

    Ids are numbered and joined once for all fits.
    """
    estimator = ALSRecommender(**options)
    user, item = estimator.getOrDefault(estimator.userCol), estimator.getOrDefault(estimator.itemCol)
    users, items = estimator.tables = index_tables(ratings, user, item)
    # Written once: folds of a recomputed table could overlap.
    ratings = cut_lineage(with_index(with_index(ratings, users, user), items, item))
    grid = ParamGridBuilder().addGrid(estimator.rank, list(ranks)).addGrid(estimator.maxIter, list(iterations)).build()
    evaluator = RankingMetricsEvaluator(
        predictionCol="recommendations", labelCol="label", metricName=metric, topK=top_k
    )
    found = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, seed=seed
    ).fit(ratings)
    rows = [
        (int(params[estimator.rank]), int(params[estimator.maxIter]), float(score))
        for params, score in zip(grid, found.avgMetrics)
    ]
    table = ratings.sparkSession.createDataFrame(rows, "rank int, iterations int, score double")
    return table.orderBy(F.desc("score"), "rank", "iterations")


def cross_validate_rmse(
    ratings: DataFrame,
    user: str = "device_id",
    item: str = "feed_id",
    ranks=RANKS,
    iterations=ITERATIONS,
    folds: int = 2,
    implicit: bool = True,
    seed: int = 12345,
) -> DataFrame:
    """(rank, iterations, rmse): the same search by rating error, best first. Settings are fitted side by side while the
    ratings are few."""
    spark = ratings.sparkSession
    users, items = tables = index_tables(ratings, user, item)
    indexed = with_index(with_index(ratings, users, user), items, item)
    # Written once with its fold: a split of a recomputed table could put a row into two parts.
    fold = F.floor(F.rand(seed) * folds).cast("int").alias("_fold")
    indexed = cut_lineage(indexed.select(f"{user}_index", f"{item}_index", F.col("rating").cast("float").alias("rating"), fold))
    count = indexed.count()
    blocks = factor_blocks(count, spark.sparkContext.defaultParallelism)

    def measured(setting: tuple[int, int]) -> tuple[int, int, float]:
        rank, rounds = setting
        errors = []
        for held_out in range(folds):
            mine = F.col("_fold") == held_out
            found = fit_als(
                indexed.where(~mine), user, item, "rating", rank, rounds, implicit=implicit, blocks=blocks, seed=seed, tables=tables
            )
            difference = F.col("prediction") - F.col("rating")
            error = found.predict(indexed.where(mine).drop("_fold")).agg(F.sqrt(F.avg(difference * difference))).first()[0]
            errors.append(error)
            # A fit's cached factors and shuffle files go when the driver's JVM collects it, which else may be after all fits.
            del found
            spark.sparkContext._jvm.System.gc()
        return rank, rounds, sum(errors) / len(errors)

    # The longest fits first, so that none of them is left for the end.
    settings = sorted(((rank, rounds) for rank in ranks for rounds in iterations), key=lambda s: -s[0] * s[1])
    with ThreadPool(max(1, min(SIDE_BY_SIDE, SIDE_RATINGS // max(count, 1)))) as pool:
        rows = pool.map(inheritable_thread_target(spark)(measured), settings, chunksize=1)
    table = spark.createDataFrame(rows, "rank int, iterations int, rmse double")
    return table.orderBy("rmse", "rank", "iterations")
