"""Near-dedup by weighted min-hashing of TF-IDF shingles.

A text is the bag of its runs of five words (lower-cased, cut at white space; a shorter
text is one run), each weighted by its count times an inverse document frequency.
Improved consistent weighted sampling draws SAMPLES samples, of which two texts share each
with the probability of their weighted Jaccard similarity. BANDS bands of samples place
similar texts in common buckets, and pairs from buckets are verified by the weighted
Jaccard similarity of the whole texts.

Document frequencies are counted over all documents in CELLS hashed cells, so the table
that is sent to all tasks has a fixed size; texts share a cell's weight wherever they share
the shingle, and weights follow shares of the documents, not their number. The random numbers of a shingle follow from its whole hash and the number of
the sample, so that no two shingles share them, however long a text is.

Pairs are not listed per bucket. Texts with equal bags become one. The hub of a bucket is
the text whose buckets have most members over all bands: the original among its copies.
Each text is verified against the greatest hub it shares a bucket with; next, texts not
yet in one class with the hub of a bucket, against that; last, within each bucket that
holds several classes, all pairs in different classes whose samples agree in at least
LEAST_SAME. Those are compared where they meet, a large bucket in pairs of blocks: first the
samples, without texts, then the texts of the documents that have a possible partner. Only
links leave the task. A class is a connected component of verified pairs, so no pair found
in a bucket is lost, and members of one class cost no pairs.

Defined cases: a null, empty or blank text has no shingles and links with nothing; a row
with a null id is a class of its own (class_id null). A document is an id: rows that share
one share its class, a link of any of their texts is its link, and all of them are kept or
none. An empty input gives no rows. Other columns are ignored. Texts are read whole, long
ones in blocks of shingles.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_text, quoted, small_batches, spread, texts
from .common import staged_in_small_batches as staged
from .components import components
from .shingles import mixed, runs, word_hashes

WORDS = 5
CELLS = 1 << 20
CELL_BLOCK = 1 << 12
BANDS, BAND = 24, 4
SAMPLES = BANDS * BAND
LEAST_SAME = 56         # of 96; a pair at the threshold of 0.8 agrees in fewer with a probability of 4e-7
RARE = 1 / 1024         # a shingle in no larger share of the documents has the full weight
KEPT_SHINGLES = 1 << 20  # of texts a task compares; pairs come sorted, so it is hubs that are met again
KEPT_SIGNATURES = 1 << 13
BLOCK, BLOCK_BYTES = 1024, 32 << 20     # members of a bucket that are compared in one task, and their texts
SMALL_GROUP, PAIRS = 64, 1 << 16        # pairs of small groups are looked at together
BREAKS = np.zeros(256, bool)
BREAKS[[9, 10, 11, 12, 13, 32]] = True


def shingles(text: str, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text, ascending, and how often each occurs."""
    words, _ = word_hashes(text.lower().encode("utf-8", "replace"), BREAKS)
    return np.unique(runs(words, min(n, len(words))) if len(words) else words, return_counts=True)


def cells_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(44)).astype(np.int64)


def distinct_cells(text: str, n: int = WORDS) -> np.ndarray:
    """The cells of a text's shingles, ascending."""
    words, _ = word_hashes(text.lower().encode("utf-8", "replace"), BREAKS)
    cells = np.sort(cells_of(runs(words, min(n, len(words)))).astype(np.int32)) if len(words) else np.zeros(0, np.int32)
    return cells[np.diff(cells, prepend=-1) > 0]


FACTORS = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
STEP = 512              # shingles whose random numbers are made at a time


def gamma_quantiles(n: int) -> np.ndarray:
    """The middle of each of n equally likely parts of Gamma(2,1)."""
    x = np.geomspace(1e-6, 60, 1 << 20)
    return np.interp((np.arange(n) + 0.5) / n, 1 - (1 + x) * np.exp(-x), x).astype(np.float32)


GAMMA = gamma_quantiles(1 << 16)


class Variates:
    """r, ln c and beta of up to STEP keys, a row per sample: Gamma(2,1), Gamma(2,1), uniform.

    They come from one 64-bit hash of key and sample, 16 bits for each of r, beta and the two
    uniform numbers of whose product c is less the logarithm. The arrays are made once and
    written over by the next keys, which costs a third less than new ones.
    """

    def __init__(self):
        room = SAMPLES * STEP
        self.hashes, self.other_hashes = np.empty(room, np.uint64), np.empty(room, np.uint64)
        self.places = np.empty(room, np.intp)
        self.floats = [np.empty(room, np.float32) for _ in range(5)]

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """r, ln c, beta, and an array of their shape for the caller's use."""
        n = len(keys)
        x, y, places, r, c, beta, other, room = (
            a[:SAMPLES * n].reshape(SAMPLES, n) for a in (self.hashes, self.other_hashes, self.places, *self.floats))
        np.multiply(keys, FACTORS[:, None], out=x)
        x ^= np.right_shift(x, HALF_WORD, out=y)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= np.right_shift(x, HALF_WORD, out=y)
        lanes = x.view(np.uint16).reshape(SAMPLES, n, 4)
        for i, u in enumerate((c, other, beta)):
            np.copyto(u, lanes[..., i])
            u += HALF
            u *= SIXTEENTH
        c *= other
        np.log(c, out=c)
        np.negative(c, out=c)
        np.log(c, out=c)
        # indices of the machine's own width, not checked again: both save half of the look-up
        np.copyto(places, lanes[..., 3])
        return GAMMA.take(places, mode="clip", out=r), c, beta, room


HALF_WORD, HALF, SIXTEENTH = np.uint64(32), np.float32(0.5), np.float32(2.0 ** -16)


@functools.cache
def variates() -> Variates:
    return Variates()


def sample(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """SAMPLES consistent weighted samples of a bag, each as a hash of shingle and level."""
    best = np.full(SAMPLES, np.inf, np.float32)
    out = np.zeros(SAMPLES, np.uint64)
    every = np.arange(SAMPLES)
    logs = np.log(weights).astype(np.float32)
    for at in range(0, len(keys), STEP):
        part = keys[at:at + STEP]
        r, a, beta, level = variates().of(part)
        np.divide(logs[at:at + STEP], r, out=level)
        level += beta
        np.floor(level, out=level)
        beta -= level
        beta -= np.float32(1)       # less the steps of r from the weight down
        r *= beta
        a += r
        who = a.argmin(1)
        least = a[every, who]
        better = np.flatnonzero(least < best)
        best[better] = least[better]
        out[better] = part[who[better]] * np.uint64(0x9FB21C651E98DF25) + level[better, who[better]].astype(np.int64).astype(np.uint64)
    return out


def document_frequencies(docs: DataFrame, n: int = WORDS) -> np.ndarray:
    """Documents per hashed cell, over all rows of ``docs`` (doc_id, text); the last entry counts the rows."""
    def count(batches):
        total, rows = np.zeros(CELLS, np.int64), 0
        for batch in batches:
            found = [np.zeros(0, np.int32)]
            for text in texts(batch):
                found.append(distinct_cells(text, n))
                rows += 1
            total += np.bincount(np.concatenate(found), minlength=CELLS)
        parts = total.reshape(-1, CELL_BLOCK)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(used, -1), pa.int64()),
            pa.array([parts[i].tobytes() for i in used] + [np.array([rows]).tobytes()], pa.binary())], ["block", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "counts": [total.tobytes()]})

    out = np.zeros(CELLS + 1, np.int64)
    schema = "block long, counts binary"
    with small_batches(docs.sparkSession):
        blocks = spread(docs.select("text")).mapInArrow(count, schema).groupBy("block").applyInPandas(add, schema).collect()
    for r in blocks:
        counts = np.frombuffer(r["counts"], np.int64)
        if r["block"] < 0:
            out[-1] = counts[0]
        else:
            out[r["block"] * CELL_BLOCK:(r["block"] + 1) * CELL_BLOCK] = counts
    return out


def inverse_frequencies(df: np.ndarray) -> np.ndarray:
    """Weights from 1 (in every document) to 2 (in at most the share RARE of them).

    They follow the share of documents alone, so that a pair of texts is as similar in a
    large corpus as in a small one. A cell's count holds what other shingles add to it; as
    a share that is the same at any size, and its mean is taken off. The range is held to 2
    so that the copies in a large group stay similar: what they share is frequent for that
    very reason, what sets them apart is rare.
    """
    share = (df[:-1] - df[:-1].mean()) / max(df[-1], 1)
    return (1 + np.log(np.clip(share, RARE, 1)) / np.log(RARE)).astype(np.float32)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags of (ascending keys, weights)."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    common = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def near_classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (least id of its class), kept (is that id)."""
    source = id_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    idf = source.sparkSession.sparkContext.broadcast(inverse_frequencies(document_frequencies(source)))

    def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = shingles(text)
        return keys, counts * idf.value[cells_of(keys)].astype(np.float64)

    def signature(keys, counts):
        w = counts * idf.value[cells_of(keys)].astype(np.float64)
        s = sample(keys, w)
        bands = np.sum(s.reshape(BANDS, BAND) * np.array([1, 0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x27D4EB2F165667C5], np.uint64), axis=1)
        return w.sum(), bands.view(np.int64), (s >> np.uint64(56)).astype(np.uint8).view(np.int8)

    def sign(batches):
        known: dict = {}        # copies that a task meets are sampled once
        for batch in batches:
            same, size, signed = [], [], []
            for text in texts(batch):
                keys, counts = shingles(text)
                own = hashlib.blake2b(keys.tobytes() + counts.tobytes(), digest_size=16).digest()
                if own not in known:
                    if len(known) >= KEPT_SIGNATURES:
                        known.clear()
                    known[own] = signature(keys, counts)
                same.append(own if len(keys) else None)
                size.append(len(text))
                signed.append(known[own])
            weight, bands, low = zip(*signed) if signed else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(same, pa.binary()), pa.array(size, pa.int64()), pa.array(weight, pa.float64()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.list_(pa.int8()))],
                ["doc_id", "same", "size", "weight", "bands", "low"])

    signed = staged(spread(source).mapInArrow(
        sign, f"doc_id {kind}, same binary, size bigint, weight double, bands array<bigint>, low array<tinyint>"), "signatures")
    sound = F.col("same").isNotNull() & F.col("doc_id").isNotNull()
    reps = staged(signed.filter(sound).groupBy("same").agg(
        F.min("doc_id").alias("rep"), F.max("size").alias("size"), F.first("weight").alias("weight"), F.first("bands").alias("bands"),
        F.first("low").alias("low")), "bags")
    sized = staged(reps.select("rep", F.posexplode("bands").alias("band", "key")).join(
        reps.select(F.posexplode("bands").alias("band", "key")).groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1"),
        ["band", "key"]), "buckets")
    members = staged(sized.drop("size").join(sized.groupBy("rep").agg(F.sum("size").alias("degree")), "rep"), "members")
    sketch = reps.select("rep", "weight", "low")

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) whose total weights and samples allow the threshold."""
        both = (pairs.join(sketch.toDF("v", "weight_v", "low_v"), "v").join(sketch.toDF("u", "weight_u", "low_u"), "u"))
        return both.filter(_allowed(threshold)).select("u", "v")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that reach the threshold; each brings its two texts together in a row."""
        def check(batches):
            known: dict = {}
            held = 0

            def bag_of(doc_id, text):
                nonlocal held
                found = known.get(doc_id)
                if found is None or found[0] != text:
                    if held >= KEPT_SHINGLES:
                        known.clear()
                        held = 0
                    found = known[doc_id] = (text, bag(text))
                    held += len(found[1][0])
                return found[1]

            for batch in batches:
                yes = []
                for a, b, x, y in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), texts(batch, "text_u"), texts(batch, "text_v")):
                    one, other = bag_of(a, x), bag_of(b, y)
                    yes.append(len(one[0]) > 0 and len(other[0]) > 0 and similarity(one, other) >= threshold)
                yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(yes, pa.bool_()))

        text = source.dropna()
        both = (pairs.join(text.toDF("v", "text_v"), "v").join(text.toDF("u", "text_u"), "u"))
        return staged(both.select("u", "v", "text_u", "text_v").mapInArrow(check, f"u {kind}, v {kind}"), "links")

    def mixed_buckets(edges: DataFrame) -> DataFrame:
        """The members of buckets that hold several classes, with their class."""
        found = components(edges)
        named = staged(members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                       .withColumn("label", F.coalesce("component", "rep")).drop("component"), "buckets")
        several = named.groupBy("band", "key").agg(F.min("label").alias("low_label"), F.max("label").alias("high_label"),
                                                   F.max_by(F.struct("rep", "label"), F.struct("degree", "rep")).alias("center"))
        return named.join(several.filter("low_label <> high_label").select("band", "key", "center"), ["band", "key"])

    copies = signed.filter(sound).select("doc_id", "same").join(reps.select("same", "rep"), "same").filter(
        "doc_id <> rep").select(F.col("rep").alias("u"), F.col("doc_id").alias("v"))
    center = members.groupBy("band", "key").agg(F.max(F.struct("degree", "rep")).alias("hub"))
    first = members.select("band", "key", "rep").join(center, ["band", "key"]).groupBy("rep").agg(F.max("hub")["rep"].alias("u"))
    edges = verified(staged(likely(first.filter("u <> rep").select("u", F.col("rep").alias("v"))), "pairs"))

    buckets = staged(mixed_buckets(edges), "mixed")
    second = staged(likely(buckets.filter("label <> center.label").select(F.col("center.rep").alias("u"), F.col("rep").alias("v"))
                           .distinct()), "pairs")
    if not second.isEmpty():
        edges = edges.union(verified(second))
        buckets = staged(mixed_buckets(edges), "mixed")
    if not buckets.isEmpty():
        cell = ["band", "key", "i", "j"]
        sizes = buckets.join(reps.select("rep", "size"), "rep")
        chunks = sizes.groupBy("band", "key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_BYTES)).cast("int").alias("chunks"))
        placed = buckets.select("band", "key", "rep", "label").join(chunks, ["band", "key"]).withColumn(
            "chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        blocks = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
            "band", "key", "rep", "label", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
        rows = blocks.join(reps.select("rep", "weight", "bands", "low"), "rep")

        # texts go only to where a pair of them may link, by weights and samples
        dealt = rows.repartition(*cell).sortWithinPartitions(*cell)
        met = staged(dealt.mapInArrow(lambda batches: met_rows(batches, cell, threshold), rows.schema), "met")
        with_text = met.join(source.dropna().toDF("rep", "text"), "rep").repartition(*cell).sortWithinPartitions(*cell)
        edges = edges.union(staged(with_text.mapInArrow(lambda batches: linked_rows(batches, cell, bag, threshold), f"u {kind}, v {kind}"), "links"))
    found = components(edges.union(copies))
    return (signed.select("doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))


def groups_of(batches: Iterator[pa.RecordBatch], cell: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables that break no group of ``cell``, and where the groups begin in each."""
    held = None

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        new[:1] = True
        for c in cell:
            x = table.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        begin = starts(held)
        if len(begin) > 1:
            yield held.slice(0, begin[-1]), begin[:-1]
            held = held.slice(begin[-1])
    if held is not None:
        yield held, np.zeros(1, np.int64)


class Sketches:
    """Members of buckets as arrays, for the question which pairs may link."""

    def __init__(self, table: pa.Table, threshold: float):
        n = len(table)
        self.low = table.column("low").combine_chunks().flatten().to_numpy().reshape(n, SAMPLES)
        self.bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(n, BANDS)
        self.weight, self.band, self.chunk, self.i, self.j = (table.column(c).to_numpy() for c in ("weight", "band", "chunk", "i", "j"))
        self.label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy().copy()
        self.least = threshold - 1e-9

    def possible(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Which pairs of rows may link. A pair that shares an earlier band is left to that band's bucket."""
        at = np.flatnonzero(self.label[u] != self.label[v])
        w, x = self.weight[u[at]], self.weight[v[at]]
        at = at[np.minimum(w, x) >= self.least * np.maximum(w, x)]
        at = at[(self.low[u[at]] == self.low[v[at]]).sum(1) >= LEAST_SAME]
        earlier = np.arange(BANDS) < self.band[u[at], None]
        at = at[~((self.bands[u[at]] == self.bands[v[at]]) & earlier).any(1)]
        out = np.zeros(len(u), bool)
        out[at] = True
        return out

    def pairs(self, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The possible pairs of the group of rows a to b, a row of the first block at a time, or all of a small group."""
        if b - a <= SMALL_GROUP:
            u, v = (x + a for x in np.triu_indices(b - a, 1))
            if self.i[a] != self.j[a]:
                across = self.chunk[u] != self.chunk[v]
                u, v = u[across], v[across]
            ok = self.possible(u, v)
            yield u[ok], v[ok]
            return
        chunk = self.chunk[a:b]
        left, right = a + np.flatnonzero(chunk == self.i[a]), a + np.flatnonzero(chunk == self.j[a])
        for r in left:
            v = right[right > r] if self.i[a] == self.j[a] else right
            v = v[self.possible(np.full(len(v), r), v)]
            if len(v):
                yield np.full(len(v), r), v


def met_rows(batches: Iterator[pa.RecordBatch], cell: list[str], threshold: float) -> Iterator[pa.RecordBatch]:
    """The members of buckets (or of two blocks of a large one) that have a possible partner there."""
    for table, begin in groups_of(batches, cell):
        sketches, keep = Sketches(table, threshold), np.zeros(len(table), bool)
        sizes = np.diff(np.append(begin, len(table)))
        for n in np.unique(sizes[sizes <= SMALL_GROUP]):        # all groups of one size at once
            some = begin[sizes == n]
            for at in range(0, len(some), max(1, PAIRS // int(n * n))):
                first = some[at:at + max(1, PAIRS // int(n * n)), None]
                u, v = ((first + x).ravel() for x in np.triu_indices(n, 1))
                ok = (sketches.i[u] == sketches.j[u]) | (sketches.chunk[u] != sketches.chunk[v])
                u, v = u[ok], v[ok]
                ok = sketches.possible(u, v)
                keep[u[ok]] = keep[v[ok]] = True
        for a, n in zip(begin[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
            for u, v in sketches.pairs(int(a), int(a + n)):
                keep[u] = keep[v] = True
        yield from table.filter(pa.array(keep)).combine_chunks().to_batches()


def linked_rows(batches: Iterator[pa.RecordBatch], cell: list[str], bag, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between the classes of each bucket (or of two blocks of a large one), until they are one."""
    for table, begin in groups_of(batches, cell):
        sketches, rep = Sketches(table, threshold), table.column("rep")
        label, left, right = sketches.label, [], []
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(table)]):
            bags: dict = {}
            for us, vs in sketches.pairs(a, b):
                for u, v in zip(us.tolist(), vs.tolist()):
                    if label[u] == label[v]:
                        continue
                    for x in (u, v):
                        if x not in bags:
                            bags[x] = bag(table.column("text")[x].as_py())
                    if len(bags[u][0]) and len(bags[v][0]) and similarity(bags[u], bags[v]) >= threshold:
                        left.append(u)
                        right.append(v)
                        own = label[a:b]
                        own[own == label[v]] = label[u]
        yield pa.RecordBatch.from_arrays([rep.take(pa.array(x, pa.int64())).combine_chunks() for x in (left, right)], ["u", "v"])


def _allowed(threshold: float):
    """Whether weights and samples (weight_u, low_u and the same of v) allow the threshold."""
    agree = F.size(F.filter(F.zip_with("low_u", "low_v", lambda x, y: x == y), lambda x: x))
    ratio = F.least("weight_u", "weight_v") >= (threshold - 1e-9) * F.greatest("weight_u", "weight_v")
    return ratio & (agree >= LEAST_SAME)


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose document stands for its class."""
    name = free_name(docs.columns, "__gone")
    gone = near_classes(docs, threshold, id_col, text_col).filter("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col(quoted(id_col)) == F.col(quoted(name)), "left_anti")
