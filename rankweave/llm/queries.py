"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.llm import ann, bpe, importance, language, middle, pii, quality, simhash, sql, toxicity
from rankweave.llm.decontamination import find_leaks
from rankweave.llm.jaccard import jaccard_groups
from rankweave.llm.licenses import scan_licenses
from rankweave.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from rankweave.llm.sharding import assign_shards


@query("op1_sharding", sql.SHARDING)
def op1_sharding(spark, sf_dir):
    dealt = assign_shards(table(spark, sf_dir, "documents"), 24)
    return dealt.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


@query("op10_quality")
def op10_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_language")
def op4_language(spark, sf_dir):
    return language.predict(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def vocabulary() -> str:
    import public_tokenizers

    return bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_bpe")
def op7_bpe(spark, sf_dir):
    words = vocabulary()
    back = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), words), words)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op5_jaccard", sql.JACCARD)
def op5_jaccard(spark, sf_dir):
    return jaccard_groups(table(spark, sf_dir, "documents"))


def _listed(spans: str) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


@query("op8_pii")
def op8_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    counts = [F.size(F.filter(F.col("base.kind"), F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


@query("op6_decontamination")
def op6_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_ann")
def op2_ann(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_licenses", sql.LICENSES)
def op3_licenses(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op11_simhash", sql.SIMHASH)
def op11_simhash(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query("op12_fill_in_middle", sql.MIDDLE)
def op12_fill_in_middle(spark, sf_dir):
    cut = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(middle.restore("output", "form"), "UTF-8"), 256).alias("restored_sha256"),
    )


@query("op13_importance", sql.IMPORTANCE)
def op13_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
