"""Quality score of a text: histogram gradient-boosted trees over document statistics.

Each text is described by numbers about its characters, words and lines alone. Trees
are grown level by level on binned features with the gradients and curvatures of the
log loss, and kept as flat arrays of nodes, so a batch of documents goes down all trees
at once by array lookups.

Defined cases: a null text counts as empty; its statistics are all 0 and it is scored
like any other. Labels that are null or belong to no document teach nothing; a document
labelled twice teaches twice. Without labels of both kinds every score is the share of
label 1 (0.5 without any). Repeated rows and ids give repeated rows; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, quoted, spread, staged, texts

FEATURES = [
    "log_chars", "log_words", "mean_word", "sd_word", "upper", "digits", "sentence_marks", "symbols", "blanks", "breaks",
    "beyond_ascii", "entropy", "distinct_words", "repeated_next", "top_word", "once_words", "title_words", "upper_words",
    "marked_words", "log_lines", "mean_line", "distinct_lines", "ended_lines", "short_lines", "distinct_bytes",
]
SAMPLE = 40_000
BINS = 64

_KIND = np.zeros(256, np.int64)            # 0 letters and the rest of UTF-8
_KIND[[*range(65, 91)]] = 1
_KIND[[*range(48, 58)]] = 2
_KIND[[*b".,;:!?'\"()-"]] = 3
_KIND[[*b"#$%&*|<>{}[]^~`\\/@_+="]] = 4
_KIND[[32, 9]] = 5
_KIND[[10, 11, 12, 13]] = 6
_KIND[[*range(128, 256)]] = 7


def describe(text: str) -> list[float]:
    """The statistics named in FEATURES."""
    if not text:
        return [0.0] * len(FEATURES)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    kinds = np.bincount(_KIND, weights=bytes_, minlength=8) / len(data)
    p = bytes_[bytes_ > 0] / len(data)
    words = text.split()
    n = len(words) or 1
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    lines = text.split("\n")
    bodies = [x.rstrip() for x in lines if x.strip()]
    m = len(bodies) or 1
    return [
        np.log1p(len(text)), np.log1p(len(words)), lengths.mean(), lengths.std(),
        kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7], float(-(p * np.log(p)).sum()),
        len(counts) / n, sum(map(eq, words, words[1:])) / n, max(counts.values(), default=0) / n,
        sum(1 for c in counts.values() if c == 1) / n,
        sum(c for w, c in counts.items() if w[0].isupper()) / n,
        sum(c for w, c in counts.items() if w.isupper()) / n,
        sum(c for w, c in counts.items() if not w[-1].isalnum()) / n,
        np.log1p(len(bodies)), np.log1p(len(text) / m), len(set(bodies)) / m,
        sum(x[-1] in ".!?" for x in bodies) / m, sum(len(x) < 40 for x in bodies) / m, float((bytes_ > 0).sum()),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics as one array of doubles."""
    source = spread(id_text(docs, id_col, text_col))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [describe(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return source.mapInArrow(run, f"doc_id {id_type}, stats array<double>")


@dataclass
class Forest:
    """Trees as arrays over all nodes; a leaf points to itself."""

    base: float
    roots: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    depth: int = 0

    def node(self, value: float) -> int:
        k = len(self.feature)
        for column, x in zip((self.feature, self.cut, self.left, self.right, self.value), (0, np.inf, k, k, value)):
            column.append(x)
        return k

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``: all trees at once, a level at a time."""
        if not self.roots:
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        feature, cut, left, right, value = map(np.array, (self.feature, self.cut, self.left, self.right, self.value))
        at = np.broadcast_to(np.array(self.roots), (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
        return 1 / (1 + np.exp(-self.base - value[at].sum(1)))


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts between the bins of each feature, at quantiles."""
    share = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, share)) for column in x.T]


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, least: float = 5.0,
               l2: float = 1.0) -> Forest:
    mean = np.clip(y.mean(), 1e-6, 1 - 1e-6) if len(y) else 0.5
    forest = Forest(float(np.log(mean / (1 - mean))), depth=depth)
    if not len(y) or y.min() == y.max():
        return forest
    edges = bin_edges(x)
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    logit = np.full(len(y), forest.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, p * (1 - p)
        root = forest.node(0.0)
        forest.roots.append(root)
        at = np.full(len(y), root)
        level = [root]
        for _ in range(depth):
            number = {k: i for i, k in enumerate(level)}
            rows = np.flatnonzero(np.isin(at, level))
            local = np.array([number[k] for k in at[rows]], np.int64)
            sums = np.zeros((2, len(level), x.shape[1], BINS))
            for f in range(x.shape[1]):
                key = local * BINS + binned[rows, f]
                for s, w in enumerate((g, h)):
                    sums[s, :, f] = np.bincount(key, weights=w[rows], minlength=len(level) * BINS).reshape(-1, BINS)
            below = sums.cumsum(-1)
            total = below[..., -1:]
            gl, hl = below
            gr, hr = total - below
            gain = np.where((hl >= least) & (hr >= least),
                            gl * gl / (hl + l2) + gr * gr / (hr + l2) - total[0] ** 2 / (total[1] + l2), -1.0)
            split = []
            for i, k in enumerate(level):
                f, b = np.unravel_index(int(gain[i].argmax()), gain[i].shape)
                if gain[i, f, b] <= 1e-6 or b >= len(edges[f]):
                    continue
                forest.feature[k], forest.cut[k] = int(f), float(edges[f][b])
                for side, gs, hs in (("left", gl, hl), ("right", gr, hr)):
                    child = forest.node(float(-rate * gs[i, f, b] / (hs[i, f, b] + l2)))
                    getattr(forest, side)[k] = child
                    split.append(child)
                own = at == k
                at[own] = np.where(binned[own, f] <= b, forest.left[k], forest.right[k])
                forest.value[k] = 0.0
            level = split
            if not level:
                break
        logit += np.array(forest.value)[at]
    return forest


def fit_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                max_rows: int = SAMPLE) -> Forest:
    """Learn from about ``max_rows`` labelled rows at most, chosen by the hash of the id."""
    known = labels.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(label_col)).cast("double").alias("label")).dropna()
    rows = stats.join(known, "doc_id").select("doc_id", "stats", "label")
    n = known.count()
    if n > max_rows:
        chance = (F.xxhash64("doc_id") % 1_000_003 + 1_000_003) % 1_000_003 / 1_000_003
        rows = rows.filter(chance < max_rows / n)
    taken = sorted(rows.collect(), key=lambda r: (str(r["doc_id"]), r["label"]))
    x = np.array([r["stats"] for r in taken], float).reshape(len(taken), len(FEATURES))
    return fit_forest(x, np.array([r["label"] for r in taken], float))


def score_quality(stats: DataFrame, forest: Forest) -> DataFrame:
    """doc_id and score for each row of :func:`document_statistics`."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)
    id_type = stats.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            scores = [shared.value.score(x[i:i + 2000]) for i in range(0, len(x), 2000)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores or [np.zeros(0)]))],
                                             ["doc_id", "score"])

    return stats.mapInArrow(run, f"doc_id {id_type}, score double")


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "quality", max_rows: int = SAMPLE) -> DataFrame:
    """Learn from ``labels`` and score every row of ``docs``: doc_id, score."""
    stats = staged(document_statistics(docs, id_col, text_col), "quality-stats")
    return score_quality(stats, fit_quality(stats, labels, id_col, label_col, max_rows))
