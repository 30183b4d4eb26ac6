import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.langid import Ftrl, features, fit_language_model, fit_temperature, gram_counts, identify, languages_of

SYLLABLES = {"aa": ["ka", "ko", "ti", "ma"], "bb": ["sch", "ung", "ein", "er"], "cc": ["eau", "oui", "ll", "é"]}


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join("".join(rnd.choices(SYLLABLES[k], k=3)) for _ in range(rnd.randrange(3, 40))), k)
            for i in range(240) for k in [rnd.choice(list(SYLLABLES))]]
    return spark.createDataFrame(rows + [(900, None, "aa"), (901, "kako", None)], "doc_id long, text string, lang string").repartition(3)


def test_held_out_accuracy_and_scores(labelled):
    model = fit_language_model(labelled, F.col("doc_id") % 3 != 1)
    got = languages_of(labelled.filter("doc_id % 3 = 1 and lang is not null"), model).join(labelled, "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    assert model.languages == ["aa", "bb", "cc"] and (model.weights == 0).mean() > 0.5     # L1 keeps few cells


def test_undetermined_null_and_long_texts(docs, labelled):
    model = fit_language_model(labelled, F.lit(True))
    frame = docs([(1, None), (2, ""), (3, "12 -- !"), (4, "ka ko tima " * 40_000), (5, "ka"), (5, "ka"), (None, "schung einer")])
    out = identify(frame, model)
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["lang_score"]) for r in out.collect()}
    assert out.columns == frame.columns + ["lang_pred", "lang_score"] and out.count() == 7
    assert [got[k][0] for k in ((1, None), (2, ""), (3, "12 -- !"))] == ["und"] * 3
    assert got[4, "ka ko tima " * 40_000][0] == "aa" and got[None, "schung einer"][0] == "bb"


def test_nothing_and_one_language_to_learn(docs):
    none = fit_language_model(docs(["a b"]), F.lit(False))
    assert [r["lang_pred"] for r in languages_of(docs(["a b"]), none).collect()] == ["und"]
    one = fit_language_model(docs(["a b", "c d"]), F.lit(True))
    assert [(r["lang_pred"], r["score"]) for r in languages_of(docs(["zz"]), one).collect()] == [("en", 1.0)]
    assert languages_of(docs([]).filter("false"), one).count() == 0


def test_sample_is_of_distinct_texts_and_bounded(spark, labelled, monkeypatch):
    """A group of copies teaches as one text; a language of few texts is learnt beside one of many."""
    learnt = []
    monkeypatch.setattr(Ftrl, "learn", lambda self, cells, x, label: learnt.append(label))
    copies = spark.range(3000).selectExpr("id + 5000 AS doc_id", "'katima komati' AS text", "'aa' AS lang")
    few = spark.createDataFrame([(9000, "xyzzy plugh", "zz")], labelled.schema)
    frame = labelled.filter("lang = 'bb' and text is not null").union(copies).union(few)
    fit_language_model(frame, F.lit(True), per_language=20, epochs=1)
    assert [learnt.count(k) for k in range(3)] == [1, 16, 1]
    learnt.clear()
    monkeypatch.setattr(langid, "MOST", 12)
    model = fit_language_model(frame, F.lit(True), per_language=20, epochs=1)
    assert [learnt.count(k) for k in range(3)] == [1, 4, 1] and model.languages == ["aa", "bb", "zz"]


def test_blocks_count_like_one_block(monkeypatch):
    text = "Grüße an alle, it is so. " * 30
    whole = gram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 64)
    assert (gram_counts(text) == whole).all() and whole.sum() == 3 * len(text) - 3


def test_ftrl_follows_its_formula():
    m = Ftrl(2, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z, n, cell = np.zeros(2), np.zeros(2), np.array([7])
    for label in (0, 1, 0, 0):
        w = np.array([0 if abs(a) <= 0.1 else -(a - np.sign(a) * 0.1) / ((1 + np.sqrt(b)) / 0.5 + 0.2) for a, b in zip(z, n)])
        p = np.exp(w) / np.exp(w).sum()
        g = p - np.eye(2)[label]
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.5 * w
        n += g * g
        m.learn(cell, np.ones(1), label)
    assert np.allclose(m.z[7], z) and np.allclose(m.n[7], n)


def test_temperature_lowers_overconfidence():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 400)
    right = np.where(rng.random(400) < 0.7, labels, 1 - labels)
    assert fit_temperature(np.eye(2)[right] * 20.0, labels) > 10


def test_features_have_unit_length():
    cells, x = features(gram_counts("abc"), np.ones(langid.CELLS))
    assert len(cells) == 6 and np.isclose(x @ x, 1)
