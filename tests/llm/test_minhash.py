import random

import numpy as np

from tidemark.llm import minhash
from tidemark.llm.components import components
from tidemark.llm.minhash import drop_near_copies, near_classes, sample, shingles, similarity
from tidemark.llm.shingles import runs, word_hashes


def test_components_are_those_of_union_find(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(150), rnd.randrange(150)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 300 + i) for i in range(60)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_words_and_runs_by_hash():
    words, starts = word_hashes("the cat thé\n cat".encode(), minhash.BREAKS)
    assert words[1] == words[3] and len(set(words)) == 3 and starts.tolist() == [0, 4, 8, 14]
    a, b = runs(words[[0, 1, 2]], 2), runs(words[[1, 2]], 2)
    assert a[1] == b[0] and a[0] != a[1] and len(runs(words, 9)) == 0
    assert runs(words[[0, 1]], 2) != runs(words[[1, 0]], 2)


def test_samples_agree_as_often_as_bags_are_similar():
    rng = np.random.default_rng(5)
    pairs = []
    for _ in range(60):
        k = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
        w = rng.random(len(k)) * 3 + 0.2
        keep = rng.random(len(k)) < 0.85
        b = (k[keep], w[keep] * np.where(rng.random(keep.sum()) < 0.2, 1.5, 1.0))
        pairs.append((similarity((k, w), b), (sample(k, w) == sample(*b)).mean()))
    exact, estimate = np.array(pairs).T
    assert abs(exact.mean() - estimate.mean()) < 0.02 and 0.6 < exact.mean() < 0.9


def test_samples_of_very_long_bags_agree_as_often_as_they_are_similar():
    """Many single shingles and a few that are repeated in one text only, such as a page footer."""
    for single, repeated, times in ((100_000, 12, 400), (200_000, 12, 300)):
        found = []
        for seed in range(3):
            keys = np.unique(np.random.default_rng(seed).integers(0, 1 << 63, single + repeated).astype(np.uint64))
            one, other = np.ones(len(keys)), np.ones(len(keys))
            at = np.random.default_rng(seed + 50).choice(len(keys), 2 * repeated, replace=False)
            one[at[:repeated]], other[at[repeated:]] = times, times
            found.append((sample(keys, one) == sample(keys, other)).mean())
            exact = similarity((keys, one), (keys, other))
        assert exact > 0.9 and abs(np.mean(found) - exact) < 0.05


def corpus():
    rnd = random.Random(9)
    base = [[f"w{rnd.randrange(5000)}" for _ in range(rnd.randrange(40, 200))] for _ in range(60)]
    texts = []
    for w in base:
        texts.append(" ".join(w))
        for edits in (1, 3, 8):
            v = list(w)
            for _ in range(edits):
                v[rnd.randrange(len(v))] = f"e{rnd.randrange(10_000)}"
            texts.append(" ".join(v))
    return texts + texts[:10] + ["", " ", "one two", "one two", "ONE two"]


def brute(texts, threshold=0.8):
    bags = [shingles(t) for t in texts]
    df = np.zeros(minhash.CELLS + 1, np.int64)
    for k, _ in bags:
        df[np.unique(minhash.cells_of(k))] += 1
    df[-1] = len(texts)
    idf = minhash.inverse_frequencies(df)
    bags = [(k, c * idf[minhash.cells_of(k)].astype(float)) for k, c in bags]
    up = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if len(bags[a][0]) and len(bags[b][0]) and similarity(bags[a], bags[b]) >= threshold:
                low, high = sorted((up[a], up[b]))
                up = [low if x == high else x for x in up]
    return up


def test_classes_are_those_of_all_pairs(docs, by_id):
    texts = corpus()
    got = by_id(near_classes(docs(texts)))
    assert [got[i]["class_id"] for i in range(len(texts))] == brute(texts)
    assert all(r["kept"] == (r["class_id"] == i) for i, r in got.items())


def test_pairs_apart_from_the_center_are_found(docs, by_id):
    """A chain: each text is near the next only, so a star around the least would lose links."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[8 * k:8 * k + 120]) for k in range(20)]
    got = by_id(near_classes(docs(texts)))
    assert [got[i]["class_id"] for i in range(20)] == brute(texts)
    assert len({r["class_id"] for r in got.values()}) == 1


def test_empty_table_null_ids_and_repeated_rows(docs):
    text = "a b c d e f g"
    assert near_classes(docs([]).filter("false")).count() == 0
    rows = near_classes(docs([(None, text), (3, text), (3, text), (4, text), (5, None), (6, "")])).collect()
    got = sorted((str(r["doc_id"]), str(r["class_id"]), r["kept"]) for r in rows)
    assert got == [("3", "3", True), ("3", "3", True), ("4", "3", False), ("5", "5", True), ("6", "6", True), ("None", "None", True)]
    frame = docs([(1, text), (2, text)])
    kept = drop_near_copies(frame)
    assert kept.columns == frame.columns and [r["doc_id"] for r in kept.collect()] == [1]
