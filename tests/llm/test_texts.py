"""Language, quality, toxicity, tokens, personal data and decontamination against plain versions and held-out rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankweave.llm import bpe, decontamination, language, pii, quality, toxicity
from rankweave.llm import text as texts
from rankweave.llm.learning import held_out
from rankweave.llm.queries import QUERIES, vocabulary
from tests.llm import brute

SF = "/root/testdata/sf0.01"
CLASH = "doc_id long, text string, score string, id string, row string, spans string"


def clash(spark, rows):
    return spark.createDataFrame([(i, t, "s", "i", "r", "p") for i, t in rows], CLASH)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_folds(spark):
    got = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


@given(st.lists(st.text(alphabet="aB é\n\t", max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_shingle_sets(rows):
    data, offsets = texts.utf8(pa.array(rows, pa.string()))
    owners, _ = texts.shingle_sets(data, offsets)
    assert np.bincount(owners, minlength=len(rows)).tolist() == [len(brute.shingles(t)) for t in rows]


def test_code_lengths_are_exact():
    train = {"x": [b"abracadabra", b"abba cad"], "y": [b"hocus pocus", b"abra"]}
    codes, owners, counts = [], [], []
    for k, name in enumerate(train):
        for t in train[name]:
            seen, n = np.unique(language.grams(np.frombuffer(t, np.uint8), np.array([0, len(t)])), return_counts=True)
            codes.append(seen), counts.append(n), owners.append(np.full(len(seen), k))
    both = np.concatenate(codes)
    trees = language.ContextTrees.build(list(train), both, np.concatenate(owners), np.concatenate(counts).astype(float))
    tests = [b"abracad", b"zebra hocus", b"", b"q", b"cad abba", b"\xc3\xa9t\xc3\xa9"]
    data, offsets = np.frombuffer(b"".join(tests), np.uint8), np.cumsum([0, *map(len, tests)])
    got = trees.text_bits(data, offsets, trees.index())
    for k, name in enumerate(train):
        assert np.allclose(got[k], [brute.code_bits(train[name], t) for t in tests], atol=1e-6)


def test_language_of_held_out_documents(docs):
    found = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(found) > 150 and (found["lang_pred"] == found["lang"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


def test_language_of_odd_rows(spark, docs):
    trees = language.fit(docs, 50)
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "the and that with of for"), (4, "der die das und nicht"), (None, "que los las para con"), (5, "the of and " * 200_000)]
    got = [(r.doc_id, r.lang_pred) for r in language.identify(clash(spark, rows), trees).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "de"), (None, "es"), (5, "en")], key=str)
    nothing = language.predict(docs.limit(0))
    assert nothing.count() == 0
    unknown = language.identify(docs.limit(3), language.fit(docs.limit(0)))
    assert {(r.lang_pred, r.score) for r in unknown.collect()} == {("und", 0.0)}


def ranks(score, label):
    order = score.rank()
    good = label == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


@pytest.mark.parametrize(("operator", "label", "least"), [(quality, "quality", 0.98), (toxicity, "toxic", 0.6)])
def test_held_out_labels(docs, labels, operator, label, least):
    found = operator.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ranks(found["score"], found[label]) > least
    assert found["score"].between(0, 1).all()


@pytest.mark.parametrize(("operator", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_odd_rows(spark, docs, labels, operator, label):
    rows = clash(spark, [(1, None), (2, ""), (2, ""), (None, "x"), (3, "word " * 300_000)])
    got = operator.classify(rows, labels.limit(0)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert operator.classify(docs.limit(0), labels).count() == 0
    odd = labels.limit(40).withColumn(label, F.when(F.col("doc_id") % 2 == 0, F.col(label)))
    assert operator.classify(docs.limit(5), odd).count() == 5


def test_updates_match_the_formulas():
    s = quality.Settings(bits=3, epochs=2)
    rnd = np.random.default_rng(0)
    examples = [(np.sort(rnd.choice(8, 3, replace=False)), rnd.random(3), float(k % 2)) for k in range(12)]
    z, n = [0.0] * 9, [0.0] * 9

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - (1 if z[i] > 0 else -1) * s.l1) / ((s.beta + n[i] ** 0.5) / s.rate + s.l2)

    for _ in range(2):
        for slots, values, y in examples:
            x = [*zip(slots.tolist(), values.tolist(), strict=True), (8, 1.0)]
            w = {i: weight(i) for i, _ in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = (p - y) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.rate * w[i]
                n[i] += g * g
    assert np.allclose(quality.ftrl(examples, s), [weight(i) for i in range(9)])


def test_units_and_kernel():
    raw = b"You i.d-i,o*t and I d i o t! " + b"abcdefgh" * 5
    body, bounds, rows = toxicity.units(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    found = [body.tobytes()[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found[:4] == [b"you", b"idiot", b"and", b"idiot"] and set(rows) == {0}
    assert found[4:] == [b"abcdefgh" * 3, (b"abcdefgh" * 4)[4:28], b"abcdefgh" * 2]

    def subsequences(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity.SPAN)):
                    key = bytes([word[i], word[j], word[k]])
                    out.setdefault(key, []).append(toxicity.DECAY ** (k - i + 1))
        return out, sum(w * w for v in out.values() for w in v) ** 0.5

    words = [b"idiot", b"idxiot", b"banana", b"id"]
    got = toxicity.kernel(words, toxicity.landmark_tables([b"idiot", b"ananas"]))
    for i, a in enumerate(words):
        for j, b in enumerate([b"idiot", b"ananas"]):
            (fa, na), (fb, nb) = subsequences(a), subsequences(b)
            want = sum(sum(v) * sum(fb.get(k, [])) for k, v in fa.items()) / ((na or 1) * nb)
            assert abs(got[i, j] - want) < 1e-6


def test_planted_insults(spark):
    rnd = random.Random(0)
    plain = ["".join(rnd.choice(["ta", "re", "no", "li", "mo", "sen"]) for _ in range(rnd.randrange(1, 4))) for _ in range(300)]
    rows, marks = [], []
    for i in range(600):
        words = [rnd.choice(plain) for _ in range(rnd.randrange(5, 60))]
        if i % 6 == 0:
            words.insert(rnd.randrange(len(words)), rnd.choice(["wurzgub", "klotzfink"]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 6 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"))
    checks = {"ta re wurzgub no": 1, "w.u.r.z.g.u.b": 1, "so k l o t z f i n k da": 1, "KLOTZFINK": 1, "ta re no": 0, "mosenli tare": 0, "": 0}
    got = toxicity.score(clash(spark, list(enumerate(checks))), model).collect()
    assert {t: int(r.score >= 0.5) for t, r in zip(checks, sorted(got, key=lambda r: r.doc_id), strict=True)} == checks


def test_tokens_are_the_library_s(spark, docs):
    from tokenizers import Tokenizer

    words = vocabulary()
    tokenizer = Tokenizer.from_str(words)
    rows = [(1, None), (2, ""), (3, "a<|endoftext|> b  c\n\n d it's ³ 数字१२ \U00010940x"), (3, "\x1c\x85\xa0 \t\n x"), (4, "nospace" * 9000), (None, "x"), (None, "x")]
    rows += [(1000 + r.doc_id, r.text) for r in docs.limit(80).collect()]
    got = bpe.decode(bpe.encode(clash(spark, rows), words, buckets=3), words).collect()
    want = sorted((str(i), tokenizer.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows)
    assert sorted((str(r.doc_id), r.ids, r.text) for r in got) == want
    assert bpe.encode(clash(spark, []), words).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [99999, -1, 64, None]), (3, [])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in bpe.decode(odd, words).collect()) == [(1, ""), (2, tokenizer.decode([64])), (3, "")]


def test_words_split_as_the_library_does():
    from tokenizers import Tokenizer

    words = vocabulary()
    tokenizer, splitter = Tokenizer.from_str(words), bpe.Splitter(words)
    for first in range(0, 0x20000, 7):
        if not 0xD800 <= first < 0xE000:
            t = f"a{chr(first)} {chr(first)}{chr(first)} 1{chr(first)}"
            assert [w.encode() for w in splitter.split(t)] == [bytes(splitter.bytes[c] for c in w) for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str(t)]


@given(st.lists(st.sampled_from(["a", "@", ".", "1", "25", "255", "300", "+", "-", " ", "(", ")", "é", "4539578763621486", "b.co", "@x.y"]), max_size=16).map("".join))
@settings(max_examples=500, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == brute.base_spans(text)


def test_base_spans_of_long_runs_take_linear_time():
    for run in ("1" * 300_000, "a" * 300_000 + " ", "1." * 150_000, "+(" * 150_000, "@a" * 150_000):
        pii.base_spans(run)


def test_redaction(spark, docs):
    model = pii.fit(docs)
    rows = [
        (1, "Write to a.b+c@mail.example.org, call +1 (269) 555-3296 4524132264652876 now"),
        (2, 'token = "6b526d9e98196c4dff5a73e8083186bb0ce9e5bd" é 10.0.0.255'), (3, "version 4.0. in 1999 and 300.1.2.3"), (4, None), (5, ""), (None, "x@y.zz"), (None, "x@y.zz"),
    ]
    got = [(r.doc_id, r.redacted) for r in pii.find(clash(spark, rows), model).collect()]
    want = [(1, "Write to [EMAIL], call [PHONE] [CARD] now"), (2, 'token = "[SECRET]" é [IP]'), (3, rows[2][1]), (4, None), (5, ""), (None, "[EMAIL]"), (None, "[EMAIL]")]
    assert sorted(got, key=str) == sorted(want, key=str)
    nothing = pii.fit(docs.limit(0))
    assert nothing.trees is None and pii.find(docs.limit(0), nothing).count() == 0


def test_every_base_span_is_listed(spark, docs):
    found = QUERIES["op8_pii"](spark, SF).join(docs, "doc_id").collect()
    for r in found:
        base = brute.base_spans(r.text)
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for k, _, _ in base) for j in range(4))


@given(st.lists(st.integers(0, 4), max_size=9), st.lists(st.integers(0, 4), max_size=12))
@settings(max_examples=200, deadline=None)
def test_alignment(item, passage):
    score, first, last = decontamination.smith_waterman(np.array(item, np.uint64), np.array(passage, np.uint64), decontamination.Settings())
    assert score == brute.align(item, passage)
    assert score == brute.align(item, passage[first:last])


def test_leaks_in_edited_copies(spark, docs):
    rnd = random.Random(5)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hosts = [r.text.split() for r in docs.where("lang = 'en'").limit(40).collect()]
    rows, planted = [], set()
    for k, (item, text) in enumerate(items):
        words = [w if rnd.random() > 0.15 else f"zq{rnd.randrange(999)}" for w in text.split()]
        host = ["lorem"] + hosts[k % len(hosts)][:200]
        at = rnd.randrange(len(host))
        rows.append((k, " ".join(host[:at] + words + host[at:])))
        planted.add((k, item))
    rows += [(500, None), (501, ""), (502, "nothing of the kind"), (None, items[0][1].upper())]
    benchmark = spark.createDataFrame([*items, items[0], (90, None), (91, ""), (92, "two words")], "item_id long, text string")
    got = decontamination.find_leaks(clash(spark, rows), benchmark).collect()
    assert planted <= {(r.doc_id, r.item_id) for r in got}
    by_id = dict(rows)
    exact = [r for r in got if r.score == 1.0 and r.doc_id is None]
    assert [(r.item_id, by_id[None][r.start : r.end].lower().startswith(items[0][1][:20].lower())) for r in exact] == [(items[0][0], True)]
    blocks = decontamination.find_leaks(clash(spark, rows), benchmark, decontamination.Settings(block_bytes=3000)).collect()
    assert {(r.doc_id, r.item_id) for r in blocks} == {(r.doc_id, r.item_id) for r in got}
    kept = decontamination.drop_leaks(clash(spark, rows), benchmark)
    assert {r.doc_id for r in kept.collect()} >= {501, 502, 500} and kept.columns == ["doc_id", "text", "score", "id", "row", "spans"]
    assert decontamination.find_leaks(clash(spark, rows), benchmark.limit(0)).count() == 0
    assert decontamination.find_leaks(clash(spark, []), benchmark).count() == 0


def test_a_leak_in_most_documents_is_found(spark):
    text = "one little passage that a great part of all documents repeats word for word at length"
    rows = [(i, f"start {i} {text} end") for i in range(300)] + [(1000 + i, f"other text number {i}") for i in range(100)]
    got = decontamination.find_leaks(clash(spark, rows), spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(300))


def test_clean_documents_share_a_little_with_short_items(spark):
    items = [(n, " ".join(f"item{n}word{k}" for k in range(n))) for n in range(3, 11)]
    rows, leaks = [], set()
    for n, text in items:
        words = text.split()
        rows += [(100 * n, f"start {text} end")]
        leaks |= {(100 * n, n)}
        if n > 3:
            rows += [(100 * n + 1, "a clean text with " + " ".join(words[:3]) + " and more")]
        if n > 4:
            rows += [(100 * n + 2, "a clean text with " + " ".join(words[1:5]) + " and more")]
        if n > 6:
            rows += [(100 * n + 3, "an edited copy " + " ".join([*words[:3], "other", *words[4:]]) + " here")]
            leaks |= {(100 * n + 3, n)}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(clash(spark, rows), benchmark).collect()} == leaks
    assert {r.doc_id for r in decontamination.drop_leaks(clash(spark, rows), benchmark).collect()} == {i for i, _ in rows} - {i for i, _ in leaks}


def test_norms_are_from_all_held_out_documents(spark):
    plain = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the river runs past the old mill").alias("text"), F.lit("en").alias("lang"))
    trees = language.fit(plain)
    late = [r["doc_id"] for r in plain.where(held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()[400:]]
    assert len(late) > 100
    odd = plain.withColumn("text", F.when(F.col("doc_id").isin(late), "zq xv kj wq").otherwise(F.col("text")))
    assert language.norms(odd, trees).rate[0] > language.norms(plain, trees).rate[0]
