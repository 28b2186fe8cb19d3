"""A training-corpus pipeline over `documents`: language, near duplicates, benchmark leaks, personal data, tokens.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next one's documents. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import bpe, decontamination, jaccard, language, pii
from rankweave.llm.queries import vocabulary
from rankweave.llm.registry import bound_batches
from rankweave.llm.storage import settle
from rankweave.operators.joins import skew_safe_join


def _free(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled ones; those without text or letters go, and those whose
    words need far more bits than the held-out documents of their best language. A null lang becomes the predicted one."""
    bound_batches(spark)
    trees = language.fit(docs)
    found = _free(docs, "_found")
    kept = language.described(docs, trees, language.norms(docs, trees), output=found).where(F.col(found)["fits"])
    return kept.withColumn("lang", F.coalesce("lang", F.col(found)["lang_pred"])).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id. Documents without an id stay; of rows
    with equal ids and equal texts one stays, the smallest by its columns. Rows that share an id but not the text are
    documents of their own.

    Documents are known by two hashes of id and text. The first is their number in the search; of two documents that
    share it (about rows squared / 2^65 do) both take the second."""
    bound_batches(spark)
    one, two = _free(docs, "_one"), _free(docs, "_two")
    keys = {one: F.xxhash64("doc_id", "text"), two: F.xxhash64(F.lit("two"), "text", "doc_id")}
    named = docs.where("doc_id is not null").withColumns(keys)
    distinct = settle(named.groupBy(F.col("doc_id"), F.col(one).alias("_a"), F.col(two).alias("_b")).agg(F.count(F.lit(1)).alias("_copies")))
    clashing = [r["_a"] for r in distinct.groupBy("_a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_a").collect()]

    def number(a: str, b: str) -> Column:
        return F.when(F.col(a).isin(clashing), F.col(b)).otherwise(F.col(a))

    groups = jaccard.jaccard_groups(named.select(number(one, two).alias("_row"), "text"), id="_row").select("_row", "component_id").distinct()
    placed = settle(distinct.withColumn("_row", number("_a", "_b")).join(groups, "_row"))
    groups_of = placed.groupBy("component_id").agg(F.min(F.struct("doc_id", "_a", "_b")).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    groups_of = settle(groups_of.where("_rows > 1"))
    largest = max(distinct.count() // (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))), 1024)
    members = skew_safe_join(placed, groups_of.drop("_rows"), ["component_id"], "inner", ["_row"], largest, groups_of.select("component_id", "_rows"))
    others = members.where(F.struct("doc_id", "_a", "_b") != F.col("_first")).select("_a", "_b", F.lit(True).alias("_goes"))
    repeated = placed.where("_copies > 1").select("_a", "_b", F.lit(False).alias("_goes"))
    marks = settle(others.unionByName(repeated).groupBy("_a", "_b").agg(F.max("_goes").alias("_goes")))
    marked = named.join(marks, (F.col(one) == F.col("_a")) & (F.col(two) == F.col("_b")), "left")
    row = F.struct(*docs.columns)
    first = marked.where("not _goes").groupBy(one, two).agg(F.min(row).alias("_row")).select("_row.*")
    return marked.where("_goes is null").select(*docs.columns).unionByName(first).unionByName(docs.where("doc_id is null"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, exact or edited."""
    bound_batches(spark)
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind's name; n_chars, where there is one, follows the text."""
    bound_batches(spark)
    clean = pii.without_personal_data(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, their number, and the digest of the text that they decode to."""
    bound_batches(spark)
    words = vocabulary()
    back = bpe.decode(bpe.encode(docs, words), words)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", tokens),
]

#: Learned models and alignment have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
