"""The pipeline's stages, each against a plain version of its own input, and the registered queries."""

import hashlib
import random
import re

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from rankweave.llm.queries import vocabulary
from tests.llm import brute
from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, "la de los que y el", None, None, None), (9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "12345 !!", "en", "s", 8), (0, rows.where("doc_id = 0").first().text, "fr", "s", 1)]
    return rows.unionByName(spark.createDataFrame(odd, rows.schema)).cache()


def words(text):
    return " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))


def test_language_keeps_readable_documents(spark, docs):
    kept = STAGES["language"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    want = sorted(str(r.doc_id) for r in docs.collect() if r.text and re.search(r"[^\W\d_]", r.text))
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert kept.where("doc_id is null").first().lang == "es"


def test_language_rejects_what_fits_no_learned_language(spark, docs):
    rnd = random.Random(3)
    noise = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 9))) for _ in range(80))
    strange = [
        "Il gatto nero dorme sul tappeto vicino alla finestra mentre la pioggia cade piano sul giardino e nessuno parla.",
        "Kissa nukkuu ikkunan vieressä ja sade putoaa hiljaa puutarhaan, mutta kukaan ei puhu mitään.",
        "Кошка спит у окна, а дождь тихо падает в сад, и никто ничего не говорит.", "猫は窓のそばで眠り、雨が静かに庭に降っている。", noise,
    ]
    known = [docs.where(f"doc_id < 9000 and lang = '{lang}'").orderBy("doc_id").first().text[:400] for lang in ("en", "fr", "de", "es")]
    known += [known[0] + " " + known[1], known[0] + ' token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" 4762461758468721', "the of and"]
    planted = spark.createDataFrame([(20000 + i, t, lang, "s", len(t)) for i, t in enumerate(strange + known) for lang in (None,)], docs.schema)
    kept = STAGES["language"](spark, docs.unionByName(planted), SF).where("doc_id >= 20000")
    assert sorted(r.doc_id - 20000 for r in kept.collect()) == list(range(len(strange), len(strange + known)))


def test_one_document_of_each_group_stays(spark, docs):
    kept = STAGES["near_duplicates"](spark, docs, SF)
    assert kept.columns == docs.columns
    groups = brute.jaccard_groups([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None])
    want = sorted(i for i, (_, c) in groups.items() if i == c)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert kept.where("doc_id is null").count() == 1


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    one, two = (" ".join(f"{name}{k}" for k in range(40)) for name in ("apple", "pear"))
    texts = [(1, one), (5, None), (5, two), (7, one + " more"), (7, "a text that is like no other one"), (7, "a text that is like no other one"), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars int")
    kept = STAGES["near_duplicates"](spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, one), (5, ""), (5, two), (7, texts[4][1]), (9, "")]


def test_stages_over_other_columns(spark):
    """Columns of other names, among them those that the stages use themselves, and no n_chars or source."""
    en = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").limit(20).collect()
    rows = [(r.doc_id, r.text, "en", "a", "b", "c", [1, 2], {"k": 1}) for r in en]
    rows += [rows[0], rows[0][:3] + ("z",) + rows[0][4:]]
    docs = spark.createDataFrame([r[:7] for r in rows], "doc_id long, text string, lang string, _found string, _one string, _changed string, leaks array<int>")
    for name in ("language", "near_duplicates", "decontamination", "personal_data"):
        kept = STAGES[name](spark, docs, SF)
        assert kept.dtypes == docs.dtypes
        if name == "near_duplicates":
            first = [r for r in kept.collect() if r.doc_id == rows[0][0]]
            assert len(first) <= 1 and all(r["_found"] == "a" for r in first)
        else:
            assert kept.count() <= len(rows)


def test_benchmark_passages_go_and_clean_documents_stay(spark, docs):
    kept = STAGES["decontamination"](spark, docs, SF)
    assert kept.columns == docs.columns
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in docs.collect() if r.text and any(f" {i} " in f" {words(r.text)} " for i in items)}
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == leaking and leaking


def test_no_personal_data_is_left(spark, docs):
    kept = STAGES["personal_data"](spark, docs, SF)
    assert kept.dtypes == docs.dtypes
    before = sorted(((str(r.doc_id), r.lang), r.text) for r in docs.collect() if r.text is not None)
    after = sorted(((str(r.doc_id), r.lang), r.text) for r in kept.collect() if r.text is not None)
    assert [k for k, _ in before] == [k for k, _ in after]
    assert not any(brute.base_spans(t) for _, t in after)
    assert all(a == b for (_, a), (_, b) in zip(before, after, strict=True) if not re.search("[0-9@]|pass|token|secret|key|pwd", a))
    assert all(r.n_chars == len(r.text) for r in kept.collect() if r.text is not None)


def test_tokens_of_all_documents(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary())
    got = sorted((str(r.doc_id), r.n_tokens, r.ids, r.decoded_sha256) for r in STAGES["tokens"](spark, docs, SF).collect())
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), len(ids), ids, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_stages_over_no_documents(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_the_whole_pipeline(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert 0 < got.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_queries_are_registered():
    names = list(entry_points.queries())
    assert [n for n in range(1, 14) if not any(name.startswith(f"op{n}_") for name in names)] == []
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op1_sharding", "op3_licenses", "op5_jaccard"])
def test_sql_twins(spark, name):
    query, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert [p for p in compare(spark, duck_connection(SF), name, query, sql, SF) if p != "both sides are empty"] == []
