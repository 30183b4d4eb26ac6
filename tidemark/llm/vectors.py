"""Near-dedup of embeddings by a forest of random-projection trees.

Vectors are compared under equal labels only, by cosine in double precision. Those of a
label of at most LEAF vectors are all compared with each other. Larger labels go down
trees: a tree splits the vectors at a random direction again and again, vectors near a
cut go to both sides (spill), and vectors are compared within leaves. A pair is counted
in the first leaf that holds both, so links are counted without a list of pairs; each
leaf passes on a spanning forest of its links, from which the components follow.

A node is split only where that leaves clearly fewer comparisons, so a dense group, which
every cut would tear, stays one leaf. How likely a cut tears a pair at the least cosine
apart follows from the spill and from the density at the cut; so many trees are grown, and
at least TREES, that such a pair is expected to share no leaf with a chance of LOSS at most.

The trees are fitted on at most about SAMPLE vectors of the large labels, chosen by hash;
all vectors of these labels go down all trees. A leaf larger than BLOCK vectors of a label
is compared in pairs of blocks, in separate tasks. Equal vectors of a label are taken as
one with a weight.

Defined cases: vectors that are null, empty or zero, or have a null or non-finite
component, and rows with a null label or id link with nothing: n_links 0, and they are
their own component. Vectors of different lengths are not compared. A repeated row is a
vector of its own, linked to its copies. An empty input gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import quoted, spread, staged
from .components import components

TREES = 6
SAMPLE = 100_000
LEAF = 4096             # vectors of a label that a leaf is meant to hold
LEAST_SAMPLE = 16       # no leaf of fewer sampled vectors is split
BLOCK = 2048
CELLS = 1 << 20         # cosines held at a time
DIRECTIONS = 8
SPILL = 0.5             # on either side of a cut, in spreads of a least close pair
WORTH = 0.8             # the most comparisons a split may leave, of those without it
LOSS = 1e-4
NO_LEAF = np.iinfo(np.int32).max


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    scale = np.abs(x).max(1, keepdims=True)     # against overflow of squares
    x = x / scale
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@dataclass
class Tree:
    """Nodes as arrays; a leaf has no sides and its own number."""

    direction: list
    cut: list
    sides: list
    torn: list          # how likely a least close pair is torn apart on the way to each node
    margin: float

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their leaves; a row comes several times where it spilt over."""
        found, stack = [], [(0, np.arange(len(x)))]
        while stack:
            k, rows = stack.pop()
            if self.sides[k] is None:
                found.append((rows, np.full(len(rows), k)))
                continue
            p = x[rows] @ self.direction[k] - self.cut[k]
            for side, inside in zip(self.sides[k], (p <= self.margin, p > -self.margin)):
                if inside.any():
                    stack.append((side, rows[inside]))
        rows, leaves = (np.concatenate(column) for column in zip(*found))
        return rows, leaves

    def leaves(self, x: np.ndarray) -> list[list[int]]:
        """The leaves of each vector; several where it spilt over."""
        out: list[list[int]] = [[] for _ in range(len(x))]
        for r, k in zip(*(column.tolist() for column in self.places(x))):
            out[r].append(k)
        return out


def grow(x: np.ndarray, full: float, least_cosine: float, seed: int, label: np.ndarray | None = None) -> Tree:
    """A tree over a sample in which each vector stands for ``full`` of all.

    Of some random directions and quantiles the cut with the fewest comparisons left is
    taken; a node where every cut leaves more than WORTH of them is a leaf. ``label``
    numbers the labels of the sample from 0.
    """
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    label = np.zeros(len(x), np.int64) if label is None else label
    # a least close pair differs along a random direction by about a normal number of this deviation
    apart = float(np.sqrt(2 - 2 * least_cosine) / np.sqrt(d))
    z = 2 * SPILL       # a pair is torn apart only if it lies two margins apart and across the cut
    beyond = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - z * math.erfc(z / math.sqrt(2)) / 2
    tree = Tree([], [], [], [], SPILL * apart)

    def node(torn: float) -> int:
        for column, value in ((tree.direction, None), (tree.cut, None), (tree.sides, None), (tree.torn, torn)):
            column.append(value)
        return len(tree.sides) - 1

    stack = [(node(0.0), np.arange(len(x)))]
    while stack:
        k, rows = stack.pop()
        if len(rows) < 2 * LEAST_SAMPLE or np.bincount(label[rows]).max() * full <= LEAF:
            continue
        directions = rng.standard_normal((d, DIRECTIONS))
        directions /= np.sqrt((directions ** 2).sum(0))
        p = x[rows] @ directions
        cuts = np.quantile(p, np.linspace(0.35, 0.65, 7), axis=0)
        lower = np.stack([(p <= c + tree.margin).mean(0) for c in cuts])
        upper = np.stack([(p > c - tree.margin).mean(0) for c in cuts])
        compared = lower ** 2 + upper ** 2
        q, j = np.unravel_index(int(np.argmin(compared)), compared.shape)
        if compared[q, j] > WORTH:
            continue
        torn = beyond * (np.abs(p[:, j] - cuts[q, j]) <= apart).mean()
        torn = 1 - (1 - tree.torn[k]) * (1 - min(1.0, torn))
        tree.direction[k], tree.cut[k], tree.sides[k] = directions[:, j].copy(), float(cuts[q, j]), (node(torn), node(torn))
        stack += [(tree.sides[k][0], rows[p[:, j] <= cuts[q, j] + tree.margin]), (tree.sides[k][1], rows[p[:, j] > cuts[q, j] - tree.margin])]
    return tree


def grow_forest(x: np.ndarray, full: float, least_cosine: float, label: np.ndarray, least: int = TREES) -> list[Tree]:
    """Trees until the sampled vectors' mean chance of losing a least close pair in all of them is LOSS at most."""
    forest, lost = [], np.ones(len(x))
    while True:
        tree = grow(x, full, least_cosine, len(forest), label)
        forest.append(tree)
        if tree.sides[0] is None:       # it holds all pairs, and no other tree is needed
            return [tree]
        torn = np.zeros(len(x))
        rows, leaves = tree.places(x)
        np.maximum.at(torn, rows, np.array(tree.torn)[leaves])
        lost *= torn
        if len(forest) >= least and lost.mean() <= LOSS:
            return forest


def place(forest: list[Tree], x: np.ndarray) -> pa.ListArray:
    """The leaves of each vector in all trees, ascending; they are numbered through the forest."""
    first = np.cumsum([0] + [len(t.sides) for t in forest])
    found = [t.places(x) for t in forest]
    rows = np.concatenate([rows for rows, _ in found])
    leaves = np.concatenate([leaves + n for (_, leaves), n in zip(found, first)]).astype(np.int32)
    order = np.lexsort((leaves, rows))
    ends = np.cumsum(np.bincount(rows, minlength=len(x)))
    return pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), leaves[order])


def padded(lists: pa.ListArray) -> np.ndarray:
    """Lists as rows of a matrix that end in NO_LEAF."""
    ends = np.diff(lists.offsets.to_numpy())
    out = np.full((len(ends), int(ends.max())), NO_LEAF, np.int32)
    out[np.arange(out.shape[1]) < ends[:, None]] = lists.flatten().to_numpy()
    return out


def first_shared(held: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least leaf that both rows of each pair hold; each pair has one."""
    out = np.empty(len(left), held.dtype)
    a, b, rest = np.zeros(len(left), np.intp), np.zeros(len(left), np.intp), np.arange(len(left))
    while len(rest):
        one, other = held[left[rest], a[rest]], held[right[rest], b[rest]]
        out[rest] = one
        a[rest] += one < other
        b[rest] += other < one
        rest = rest[one != other]
    return out


def link_block(x: np.ndarray, held: np.ndarray, weight: np.ndarray, chunk: np.ndarray, leaf: int, i: int, j: int,
               least_cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weighted links of each row in one block pair of a leaf, from pairs that no earlier leaf holds, and their spanning forest."""
    a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    links, edges = np.zeros(len(x), np.int64), []
    step = max(1, CELLS // max(1, len(b)))
    for at in range(0, len(a), step):
        # a block against itself: no row meets one before it
        own, others = a[at:at + step], b[at:] if i == j else b
        left, right = np.nonzero(x[own] @ x[others].T >= least_cosine)
        left, right = own[left], others[right]
        if i == j:
            later = left < right
            left, right = left[later], right[later]
        new = first_shared(held, left, right) == leaf
        left, right = left[new], right[new]
        np.add.at(links, left, weight[right])
        np.add.at(links, right, weight[left])
        edges += spanning(left, right, len(x))
    if len(edges) >= len(x):
        edges = spanning(*np.array(edges).T, len(x))
    return links, edges


def spanning(left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A pair per row that joins it to the least row of its component."""
    if not len(left):
        return []
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        differ = label[left] != label[right]
        if not differ.any():
            break
    while (label != label[label]).any():
        label = label[label]
    return [(r, int(c)) for r, c in enumerate(label.tolist()) if r != c]


def link_vectors(vectors: DataFrame, least_cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    # floats stay floats, anything else is compared as doubles
    element = getattr(vectors.schema[vector_col].dataType, "elementType", None)
    width = "float" if isinstance(element, FloatType) else "double"
    rows = vectors.select(F.col(quoted(id_col)).alias("vec_id"), F.col(quoted(vector_col)).cast(f"array<{width}>").alias("embedding"),
                          F.col(quoted(label_col)).alias("label"))
    limit = F.lit(float("inf"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
             & F.exists("embedding", lambda x: x != 0))
    good = rows.filter(sound)
    classes = staged(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vectors")
    links, found = _links(classes, least_cosine, trees, sample)
    reps = classes.join(links, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    linked = good.join(staged(reps, "vector-classes"), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(sound, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                                 F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, least_cosine: float, trees: int, sample: int) -> tuple[DataFrame, DataFrame]:
    """Weighted links of each class (rep, links) and the components (node, component)."""
    spark = classes.sparkSession
    kind = np.float32 if isinstance(classes.schema["embedding"].dataType.elementType, FloatType) else np.float64
    sizes = classes.select(F.size("embedding").alias("dim")).distinct().collect()    # one row per vector length
    every_link = every_edge = None
    for dim in (r["dim"] for r in sizes):
        own = classes.filter(F.size("embedding") == dim)
        # labels too large to be compared whole; staged, so that a short list of them is sent to all
        large = staged(own.groupBy("label").count().filter(F.col("count") > LEAF), "large-labels")
        n = large.agg(F.sum("count")).first()[0] or 0
        x, full, label = np.zeros((0, dim)), 1.0, np.zeros(0, np.int64)
        if n:
            chance = (F.xxhash64("embedding") % 1_000_003 + 1_000_003) % 1_000_003 / 1_000_003
            taken = own.join(large, "label", "left_semi").filter(chance < sample / n).select("embedding", "label").toArrow()
            if len(taken):
                x = unit(np.array(taken.column(0).combine_chunks().flatten(), kind).reshape(-1, dim))
                label = taken.column(1).combine_chunks().dictionary_encode().indices.to_numpy()
                full = n / len(x)
        forest = spark.sparkContext.broadcast(grow_forest(x, full, least_cosine, label, trees))
        whole = sum(len(t.sides) for t in forest.value)         # the one leaf of a label that is compared whole

        def assign(batches, dim=dim, forest=forest, whole=whole):
            for batch in batches:
                flat = np.array(batch.column("embedding").flatten(), kind).reshape(-1, dim)
                split = np.array(batch.column("split"), bool)
                order = np.argsort(~split, kind="stable")       # those that are split first
                small = pa.array([[whole]] * int((~split).sum()), pa.list_(pa.int32()))
                leaves = pa.concat_arrays([place(forest.value, unit(flat[split])), small]) if split.any() else small
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(pa.array(order)) for c in ("rep", "weight", "label")),
                    pa.array([v.tobytes() for v in flat[order]], pa.binary()), leaves],
                    ["rep", "weight", "label", "vector", "leaves"])

        kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
        flagged = own.join(large.select("label", F.lit(True).alias("split")), "label", "left").select(
            "rep", "weight", "label", "embedding", F.coalesce("split", F.lit(False)).alias("split"))
        placed = staged(spread(flagged).mapInArrow(
            assign, f"rep {kinds['rep']}, weight long, label {kinds['label']}, vector binary, leaves array<int>"), "leaves")
        at = placed.select("*", F.explode("leaves").alias("leaf"))
        key = ["leaf", "label"]
        chunks = staged(placed.select("label", F.explode("leaves").alias("leaf")).groupBy(*key).agg(
            F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks")).filter("chunks > 1"), "large-leaves")
        at = at.join(chunks, key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn(
            "chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        blocks = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
            "rep", "weight", "label", "vector", "leaves", "leaf", "chunk",
            F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))

        def compare(rows: pa.Table) -> pa.Table:
            leaf, i, j = (rows.column(c)[0].as_py() for c in ("leaf", "i", "j"))
            x = unit(np.frombuffer(b"".join(rows.column("vector").to_pylist()), kind).reshape(len(rows), -1))
            links, edges = link_block(x, padded(rows.column("leaves").combine_chunks()), rows.column("weight").to_numpy(),
                                      rows.column("chunk").to_numpy(), leaf, i, j, least_cosine)
            ids, linked = rows.column("rep").combine_chunks(), np.flatnonzero(links)
            return pa.Table.from_arrays([
                ids.take(pa.array(np.concatenate([linked, [a for a, _ in edges]]).astype(np.int64))),
                ids.take(pa.array(np.concatenate([linked, [b for _, b in edges]]).astype(np.int64))),
                pa.array(np.concatenate([links[linked], np.zeros(len(edges), np.int64)]))], ["u", "v", "links"])

        found = staged(blocks.repartition(*key, "i", "j").groupBy(*key, "i", "j").applyInArrow(
            compare, f"u {kinds['rep']}, v {kinds['rep']}, links long"), "vector-links")
        links = found.filter("links > 0").select(F.col("u").alias("rep"), "links")
        edges = found.filter("links = 0").select("u", "v")
        every_link = links if every_link is None else every_link.union(links)
        every_edge = edges if every_edge is None else every_edge.union(edges)
    if every_link is None:
        every_link = classes.select("rep", F.lit(0).cast("long").alias("links")).limit(0)
        every_edge = classes.select(F.col("rep").alias("u"), F.col("rep").alias("v")).limit(0)
    return every_link.groupBy("rep").agg(F.sum("links").alias("links")), components(every_edge)
