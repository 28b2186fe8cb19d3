"""Sharding, neighbours, licenses, near duplicates and components against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from rankweave.llm import ann, licenses, sharding
from rankweave.llm.graph import components
from rankweave.llm.jaccard import Segments, jaccard_groups
from tests.llm import brute

CLASH = "doc_id long, text string, shard string, size string, id string, `group` string, chunk string"


def clash(rows):
    return [(i, t, "x", "y", "z", "g", "c") for i, t in rows]


def test_shards_are_contiguous_balanced_and_gapless(spark):
    rows = [(i, random.Random(i).choice(["same"] * 3 + ["w " * (i % 70)])) for i in range(500)] + [(None, "a"), (7, None), (7, None), (8, "é" * 5)]
    got = sharding.assign_shards(spark.createDataFrame(clash(rows), CLASH), 24).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    assert sorted(by) == list(range(24))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / 24) <= largest
    assert {r["size"] for r in got if r.doc_id == 7 and r.text_crc32 == 0} == {8}
    assert next(r["size"] for r in got if r.doc_id == 8 and r["size"] == 18)


def test_shards_of_no_rows_and_kept_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign_shards(empty).count() == 0
    kept = sharding.assign_shards(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"), 2, keep=["text"]).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(1, "a"), (2, "b")} and {r.shard for r in kept} == {0, 1}


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", i % 3) for i in range(40)], "doc_id long, text string, extra int")
    sharding.write_shards(docs, f"{tmp_path}/s", 4)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert sorted(map(tuple, back.select("doc_id", "text", "extra").collect())) == sorted(map(tuple, docs.collect()))
    assert back.select("shard").distinct().count() == 4


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, list string")


def test_neighbours_are_exact_when_all_lists_are_read(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 20)) * rng.uniform(0.5, 2, (300, 1))
    x[150:250] = x[150]  # a hot vector: ties go to the smaller id
    rows = [(i, v.tolist(), "s", "l") for i, v in enumerate(x)]
    odd = [(900, None), (920, []), (940, [0.0] * 20), (960, [None] + [1.0] * 19), (980, [float("nan")] + [1.0] * 19), (1000, [float("inf")] * 20), (1020, [1.0] * 19), (None, [1.0] * 20)]
    df = vectors(spark, rows + [(i, v, "s", "l") for i, v in odd])
    found = ann.search(df, F.col("vec_id") % 20 == 0, ann.Settings(probe=1.0, doubt=100.0, part=32)).collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 300, 20))
    for q, mine in got.items():
        scores = [sum(a * b for a, b in zip(x[q], v, strict=True)) for v in x]
        want = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[i], i))[:20]
        assert [v for _, v, _ in sorted(mine)] == want
        assert [k for k, _, _ in sorted(mine)] == list(range(1, 21))


def test_neighbours_of_small_and_empty_tables(spark):
    assert ann.search(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(vectors(spark, [(0, [1.0, 0.0], "", "")]), F.col("vec_id") == 0).count() == 0
    few = vectors(spark, [(i, [1.0, float(i)], "", "") for i in range(5)] + [(3, [1.0, 3.0], "", "")])
    found = ann.search(few, F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id) for r in found) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_neighbours_beside_one_long_vector(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 64))
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    x[599] *= 30_000
    df = vectors(spark, [(i, v.tolist(), "s", "l") for i, v in enumerate(x)])
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, ann.Settings(sample=60, probe=1.0, doubt=100.0)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    assert {q: mine == set(np.argsort(-near[q])[:20].tolist()) for q, mine in got.items()} == dict.fromkeys(range(0, 600, 20), True)


def test_queries_come_to_a_task_in_bounded_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 12))
    df = vectors(spark, [(i, v.tolist(), "s", "l") for i, v in enumerate(x)] + [(8, x[8].tolist(), "s", "l")] * 90)
    seen, apply = [], PandasCogroupedOps.applyInArrow

    def watched(self, *args, **more):
        asking = self._gd2._df
        keys = [c for c in ("group", "block") if c in asking.columns]
        seen.append(asking.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return apply(self, *args, **more)

    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", watched)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 2 == 0, ann.Settings(sample=50, probe=1.0, doubt=100.0, asked=20)).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    assert got == {q: dict(enumerate(np.argsort(-near[q])[:20].tolist(), 1)) for q in range(0, 400, 2)}
    assert len(seen) == 1 and 1 <= seen[0] <= 60


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids])
    hit, found = 0, {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q, mine in found.items():
        order = [i for i in ids[np.lexsort((ids, -(x @ rows[q])))] if i != q][:20]
        hit += len(mine & set(order))
    assert hit / (20 * len(found)) >= 0.9


def test_licenses_in_any_spelling(spark):
    mit = dict(licenses.TEXTS[:1])["MIT"]
    rows = [
        (1, "Copyright (c) 2001 Somebody\nAll rights reserved.\n\n" + mit.upper().replace("SOFTWARE", "software")),
        (2, "Text before.\r\nreleased under the   mit LICENCE\r\nafter"),
        (3, mit + " and more"), (4, None), (5, ""), (6, "Licensed under CC BY-NC 4.0."), (6, "no permission here"),
    ]
    got = sorted(map(tuple, licenses.scan_licenses(spark.createDataFrame(clash(rows), CLASH)).collect()))
    assert got == [(1, 0, "MIT"), (2, 2, "MIT"), (6, 0, "CC-BY-NC-4.0"), (6, 1, "CC-BY-NC-4.0")]
    assert licenses.scan_licenses(spark.createDataFrame([], CLASH)).count() == 0


def test_handed_in_wordings_need_no_mention_of_a_license(spark):
    wording = "Redistribution and use in source and binary forms, with or without modification, are allowed."
    known = spark.createDataFrame([("X", wording), ("Y", " -- ")], "license string, text string")
    rows = [(1, "Copyright 2001 A\n" + wording.upper()), (2, f"before\n{wording}\n\n--"), (3, None), (4, ""), (5, wording + " Not")]
    got = sorted(map(tuple, licenses.scan_licenses(spark.createDataFrame(clash(rows), CLASH), known).collect()))
    assert got == [(1, 0, "X"), (1, 2, "X"), (2, 2, "X")]


def test_every_wording_passes_the_word_filter():
    import re

    assert all(re.search(licenses.MENTIONS, text.lower()) for _, text in licenses.TEXTS)


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 150)] + [(5, 5)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(70)]
    rnd.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.components({n for link in links for n in link}, links)
    assert got == {n: c for n, c in want.items() if any(n in link and link[0] != link[1] for link in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    vocabulary, rows = [f"w{i}" for i in range(400)], []
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    for _ in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 4, 5, 6, 9, 20, 33, 64, 130]))] + (passage if rnd.random() < 0.3 else [])
        for _ in range(rnd.choice([1, 2, 6])):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, len(words) // 14])):
                at = rnd.randrange(len(words))
                words[at : at + rnd.choice([0, 1])] = [rnd.choice(vocabulary)]
            rows.append((len(rows), rnd.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize(("seed", "segments"), [(1, Segments()), (2, Segments(0.05, 1, 0.3))])
def test_near_duplicates_against_all_pairs(spark, seed, segments):
    rows = near_copies(seed)
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n"), (len(rows) + 3, rows[5][1].upper())]
    df = spark.createDataFrame(clash(rows), CLASH).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(df, segments=segments, buckets=3).collect()}
    assert got == brute.jaccard_groups(rows)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = "one two three four five six seven eight"
    rows = [(3, text), (3, text), (9, text + " "), (None, text), (None, None), (4, "other words that stand here alone"), (4, text)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(False, 3, 4, 3), (False, 3, 4, 3), (False, 4, 2, 4), (False, 4, 4, 3), (False, 9, 4, 3), (True, 0, 0, None), (True, 0, 4, None)]
    assert jaccard_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
