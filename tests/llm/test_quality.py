import random

import numpy as np

from tidemark.llm.quality import FEATURES, bin_edges, classify_quality, describe, fit_forest


def walk(forest, row):
    total = forest.base
    for k in forest.roots:
        while forest.left[k] != k:
            k = forest.left[k] if row[forest.feature[k]] <= forest.cut[k] else forest.right[k]
        total += forest.value[k]
    return 1 / (1 + np.exp(-total))


def test_flat_arrays_score_like_a_walk_and_learn():
    rng = np.random.default_rng(3)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = fit_forest(x[:400], y[:400], trees=40)
    score = forest.score(x)
    assert np.allclose(score, [walk(forest, r) for r in x])
    assert ((score[400:] >= 0.5) == y[400:]).mean() > 0.95
    assert all(len(e) == len(set(e)) for e in bin_edges(x))


def test_one_kind_of_label_or_none():
    x = np.zeros((4, 2))
    assert np.allclose(fit_forest(x, np.ones(4)).score(x), 1, atol=1e-5)
    assert np.allclose(fit_forest(x[:0], np.ones(0)).score(x), 0.5)


def make(rnd, good):
    words = ["the", "a", "cat", "sits", "here", "often", "and", "sees", "birds"]
    n = rnd.randrange(5, 60)
    return " ".join(rnd.choices(words, k=n)).capitalize() + "." if good else " | ".join(rnd.choices(["##x", "BUY!!", "$$$"], k=n))


def test_held_out_accuracy_nulls_and_repeats(spark, docs, by_id):
    rnd = random.Random(7)
    good = [rnd.random() < 0.6 for _ in range(300)]
    rows = [(i, make(rnd, g)) for i, g in enumerate(good)]
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good) if i % 5] + [(3, None), (99_999, 1), (None, 0)], "doc_id long, quality int")
    frame = docs(rows + [(500, None), (501, ""), (502, "word " * 100_000), (502, "word " * 100_000), (None, "x")])
    out = classify_quality(frame, labels)
    assert out.count() == 305
    got = by_id(out)
    assert np.mean([(got[i]["score"] >= 0.5) == good[i] for i in range(0, 300, 5)]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[500]["score"] == got[501]["score"]


def test_empty_tables(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert classify_quality(docs([]).filter("false"), labels).count() == 0
    assert [r["score"] for r in classify_quality(docs(["a"]), labels).collect()] == [0.5]


def test_statistics():
    d = dict(zip(FEATURES, describe("One two two.\nONE 12")))
    assert d["repeated_next"] == 0 and np.isclose(d["distinct_words"], 1) and np.isclose(d["upper_words"], 0.2)
    assert describe("") == [0.0] * len(FEATURES) and len(describe(" \n ")) == len(FEATURES)
