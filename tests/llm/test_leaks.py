"""Benchmark leaks: the whole result against brute force, templated items, and items of many copies."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rankweave.llm import decontamination
from rankweave.llm.decontamination import Settings, drop_leaks, find_leaks
from tests.llm import brute

CLASH = "doc_id long, text string, leaks string, id string, item string, score string"


def found(spark, docs, items, settings=Settings()):
    rows = spark.createDataFrame([(d, t, *["x"] * 4) for d, t in docs], CLASH)
    bench = spark.createDataFrame(items, "item_id long, text string")
    leaks = {(r.doc_id, r.item_id, r.points) for r in find_leaks(rows, bench, settings).collect()}
    kept = {r.doc_id for r in drop_leaks(rows, bench, settings).collect()}
    assert kept == {d for d, _ in docs} - {d for d, *_ in leaks}
    return leaks


@pytest.mark.parametrize("seed", range(3))
def test_all_leaks_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    stem = "choose the one right answer to this question".split()
    items = []
    for i in range(40):
        body = rnd.choices(vocabulary, k=rnd.randrange(2, 25))
        items.append((i, " ".join((stem if i % 2 else []) + body)))
    items += [(100, items[3][1]), (101, ""), (102, None), (103, " ".join(stem))]
    docs = []
    for d in range(60):
        text = rnd.choices(vocabulary, k=rnd.randrange(60))
        if d % 3 == 0:
            w = items[rnd.randrange(40)][1].split()
            at = rnd.randrange(max(len(w) // 2, 1))
            part = [x if rnd.random() > 0.1 else rnd.choice(vocabulary) for x in w[at:]]
            text[10:10] = part
        if d % 4 == 0:
            text += stem
        docs.append((d, " ".join(text).title() if d % 2 else ", ".join(text)))
    docs += [(200, None), (201, ""), (202, docs[0][1])]
    settings = Settings(few_items=3, few_share=0.0, rare_rows=2)
    assert found(spark, docs, items, settings) == brute.leaks(docs, items, settings)


def test_the_stem_of_a_template_is_no_leak(spark):
    items = [(i, f"Which of the following is the correct answer to question number n{i} about topic t{i * 7 % 300}?") for i in range(300)]
    stem = "which of the following is the correct answer to question number "
    docs = [(d, f"own{d} words{d} here{d} " + (stem + f"other{d} ") * 5) for d in range(60)]
    docs += [(100, "before " + items[17][1].upper() + " after"), (101, f"we ask about topic t{items[5][0]}")]
    assert {x[:2] for x in found(spark, docs, items)} == {(100, 17)}


def test_an_item_that_most_documents_hold_is_found(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = [(d, f"a{d} b{d} {passage} c{d}" if d % 10 else f"clean{d} text{d} only{d}") for d in range(300)]
    items = [(1, passage), (2, passage), (3, "some quite different words that nobody else ever wrote down")]
    leaks = found(spark, docs, items)
    assert {x[:2] for x in leaks} == {(d, i) for d in range(300) if d % 10 for i in (1, 2)}


def test_items_without_seeds_of_their_own_count_as_a_whole(spark):
    items = [(i * 20 + j, f"the {a} is {b} now") for i, a in enumerate(["sky", "sea"]) for j, b in enumerate("red blue grey black".split())]
    settings = Settings(few_items=0, few_share=0.0)
    leaks = found(spark, [(1, "they say the sky is blue now"), (2, "the sky is"), (3, "the sea is blue")], items, settings)
    assert {x[:2] for x in leaks} == {(1, 1)}


def test_a_block_of_many_items_is_indexed_in_seconds():
    import time

    texts = pa.array([f"item number {i} asks about thing {i * 7 % 50_021} and about {i % 977} others" for i in range(160_000)])
    start = time.perf_counter()
    index = decontamination.Index.build(pa.array(range(160_000)), texts, Settings())
    told = index.telling(np.ones(len(index.seeds), np.int64), 10, Settings())
    assert time.perf_counter() - start < 60 and len(told.seeds) <= len(index.seeds)
