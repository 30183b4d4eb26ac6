import numpy as np
import pytest

from tidemark.llm import vectors
from tidemark.llm.vectors import grow, link_vectors, unit

KIND = "vec_id long, embedding array<float>, label int, weight string"


def brute(rows, least):
    """Links and components by comparing all pairs."""
    ok = [i for i, (k, v, label, _) in enumerate(rows) if k is not None and label is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    links, up = [0] * len(rows), {i: i for i in ok}
    for a in ok:
        for b in ok:
            x, y = rows[a], rows[b]
            if a < b and x[2] == y[2] and len(x[1]) == len(y[1]):
                p, q = unit(np.array([x[1]], np.float32))[0], unit(np.array([y[1]], np.float32))[0]
                if p @ q >= least:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((up[a], up[b]))
                    up = {i: low if c == high else c for i, c in up.items()}
    return sorted((rows[i][0] if rows[i][0] is not None else -1, links[i],
                   -1 if rows[i][0] is None else rows[i][0] if i not in up else min(rows[j][0] for j in ok if up[j] == up[i]))
                  for i in range(len(rows)))


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"], -1 if r["component_id"] is None else r["component_id"]) for r in rows)


def points(seed=4, groups=30, each=12, d=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.standard_normal(d)
        for _ in range(each):
            rows.append((len(rows), (base + rng.standard_normal(d) * 0.25).astype(np.float32).tolist(), g % 3, "x"))
    return rows


@pytest.mark.parametrize("leaf, block", [(4096, 2048), (60, 16)])
def test_links_are_those_of_all_pairs(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(vectors, "LEAF", leaf)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = points()
    rows += [(1000 + i, rows[0][1], 0, "x") for i in range(40)]                    # equal vectors
    rows += [(2000, [2 * x for x in rows[5][1]], rows[5][2], "x")]                 # parallel ones
    assert found(link_vectors(spark.createDataFrame(rows, KIND).repartition(3), 0.9)) == brute(rows, 0.9)


def test_unsound_vectors_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1, "x"), (2, v, 1, "x"), (2, v, 1, "x"), (3, v, None, "x"), (None, v, 1, "x"), (4, None, 1, "x"), (5, [], 1, "x"),
            (6, [0.0] * 3, 1, "x"), (7, [1.0, None, 3.0], 1, "x"), (8, [1.0, float("nan"), 3.0], 1, "x"),
            (9, [1.0, float("inf"), 3.0], 1, "x"), (10, [1.0, 2.0], 1, "x"), (11, [1e30, 2e30, 3e30], 1, "x"), (12, v, 2, "x")]
    got = found(link_vectors(spark.createDataFrame(rows, KIND)))
    assert got == brute(rows, 0.93)
    assert (2, 3, 1) in got and (11, 3, 1) in got and (8, 0, 8) in got


def test_empty_table(spark):
    assert link_vectors(spark.createDataFrame([], KIND)).count() == 0


def test_spill_keeps_close_pairs_together():
    rng = np.random.default_rng(8)
    x = unit(rng.standard_normal((3000, 24)))
    y = unit(x + rng.standard_normal(x.shape) * 0.06)
    tree = grow(x, 10.0, 0.93, 1)
    a, b = tree.leaves(x), tree.leaves(y)
    assert len({k for own in a for k in own}) > 4
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)]) > 0.9


def test_dense_group_loses_no_close_pair(monkeypatch):
    """Vectors of a mutual cosine of about 0.9, far more than a leaf is meant to hold."""
    monkeypatch.setattr(vectors, "LEAF", 256)
    rng = np.random.default_rng(3)
    base, d = unit(rng.standard_normal((1, 64))), 64
    x = unit(np.sqrt(0.9) * base + np.sqrt(0.1 / d) * rng.standard_normal((6000, d)))
    a, b = np.nonzero(x[:200] @ x.T >= 0.93)
    together = np.zeros(len(a), bool)
    for seed in range(vectors.TREES):
        own = [set(leaves) for leaves in grow(x, 1.0, 0.93, seed).leaves(x)]
        together |= np.array([not own[i].isdisjoint(own[j]) for i, j in zip(a, b)])
    assert len(a) > 10_000 and together.all()


def test_doubles_are_compared_as_doubles(spark):
    """A cosine a billionth above the threshold, and components beyond what a float holds."""
    def pair(c):
        return [1.0, 0.0], [c, (1 - c * c) ** 0.5]
    above, below = pair(0.93 + 1e-9), pair(0.93 - 1e-9)
    rows = [(1, above[0], "a"), (2, above[1], "a"), (3, below[0], "b"), (4, below[1], "b"), (5, [1e39, 0.0], "c"), (6, [2e39, 1e30], "c"),
            (7, [float("inf"), 1.0], "c"), (8, [1.0, None], "c"), (9, None, "c"), (10, [1.0, 0.0], None), (11, [0.0, 0.0], "c")]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert [got[i][0] for i in range(1, 12)] == [1, 1, 0, 0, 1, 1, 0, 0, 0, 0, 0]
    assert got[2] == (1, 1, False) and got[6] == (1, 5, False) and got[4] == (0, 4, True)


def planted(n, d, least, seed=5):
    """Spread vectors, and for each one of exactly that cosine to it."""
    rng = np.random.default_rng(seed)
    x = unit(rng.standard_normal((n, d)))
    side = rng.standard_normal(x.shape)
    side = unit(side - (side * x).sum(1, keepdims=True) * x)
    return x, least * x + np.sqrt(1 - least * least) * side


def share_a_leaf(forest, x, y):
    together = np.zeros(len(x), bool)
    for tree in forest:
        together |= [not set(a).isdisjoint(b) for a, b in zip(tree.leaves(x), tree.leaves(y))]
    return together


def test_memberships_grow_slowly(monkeypatch):
    """Four times the vectors, in how many leaves each lies."""
    monkeypatch.setattr(vectors, "LEAF", 256)
    x, _ = planted(16_000, 64, 0.93)
    per_vector = [np.mean([len(own) for seed in range(vectors.TREES) for own in grow(y, 1.0, 0.93, seed).leaves(y)]) for y in (x[::4], x)]
    assert per_vector[1] / per_vector[0] < 1.6


def test_labels_of_a_leaf_are_compared_whole(spark, monkeypatch):
    """Leaves are of one label: many labels do not make their trees deeper."""
    monkeypatch.setattr(vectors, "LEAF", 40)
    tables, real = {}, vectors.staged
    monkeypatch.setattr(vectors, "staged", lambda df, name: tables.setdefault(name, real(df, name)))
    rows = [(i, v, i // 36, "x") for i, v, _, _ in points()]
    rows += [(1000 + i, v, 50, "x") for i, v, _, _ in points(seed=5)]               # a label that is split
    assert found(link_vectors(spark.createDataFrame(rows, KIND), 0.9)) == brute(rows, 0.9)
    held = tables["leaves"].select("label", "leaves").collect()
    assert {len(r["leaves"]) for r in held if r["label"] < 50} == {1}
    assert min(len(r["leaves"]) for r in held if r["label"] == 50) >= vectors.TREES


def test_deep_forest_loses_next_to_no_close_pair(monkeypatch):
    """Pairs of exactly the least cosine, a hundred leaves and more."""
    monkeypatch.setattr(vectors, "LEAF", 128)
    x, y = planted(20_000, 64, 0.93)
    forest = vectors.grow_forest(x, 1.0, 0.93, np.zeros(len(x), int), least=1)
    assert len(set(forest[0].places(x)[1].tolist())) > 100
    assert len(forest) > 3 and share_a_leaf(forest, x, y).mean() >= 0.9995
    assert share_a_leaf(forest[:1], x, y).mean() < 0.95


def test_dense_group_among_spread_vectors_loses_no_close_pair(monkeypatch):
    monkeypatch.setattr(vectors, "LEAF", 256)
    rng = np.random.default_rng(6)
    base, d = unit(rng.standard_normal((1, 64))), 64
    x = unit(np.sqrt(0.9) * base + np.sqrt(0.1 / d) * rng.standard_normal((3000, d)))
    both = np.concatenate([x, planted(6000, d, 0.93)[0]])
    forest = vectors.grow_forest(both, 1.0, 0.93, np.zeros(len(both), int))
    a, b = np.nonzero(x[:200] @ x.T >= 0.93)
    assert len(a) > 5_000 and share_a_leaf(forest, x[a], x[b]).all()
