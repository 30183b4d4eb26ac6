"""Language identification by sparse multinomial logistic regression.

Features are character n-grams (1 to 3 code points of the lower-cased text, blanks
included) hashed to CELLS cells, weighted by sublinear term frequency times inverse
document frequency and scaled to unit length. Document frequencies are counted over all
labelled rows. The weights are learnt by follow-the-regularised-leader (proximal, per
coordinate) with an L1 and an L2 penalty, on a sample of at most SAMPLE distinct texts per
language and MOST over all (each language has one at least), those of the least hashes; a
fifth of the sample is held back to fit the temperature of the softmax.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is
every text where nothing was labelled. Rows with a null language teach nothing. Long
texts are read whole, in blocks. With one language learnt, it is predicted with score 1.
Repeated rows and ids give repeated rows, and teach as one text; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import quoted, spread

CELLS = 1 << 16
SAMPLE, MOST = 1000, 20_000
BLOCK = 1 << 20
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]").search


def gram_counts(text: str) -> np.ndarray:
    """How often each cell occurs in a text."""
    text = text.lower()
    counts = None
    for at in range(0, max(1, len(text)), BLOCK):
        c = np.frombuffer(text[at:at + BLOCK + 2].encode("utf-32-le", "replace"), np.uint32)
        one = c * np.uint32(2654435761)
        two = (c[:-1] * np.uint32(2246822519) + c[1:]) * np.uint32(3266489917)
        three = ((c[:-2] * np.uint32(668265263) + c[1:-1]) * np.uint32(374761393) + c[2:]) * np.uint32(2869860233)
        cells = np.concatenate([one[:BLOCK], two[:BLOCK], three[:BLOCK]]) >> np.uint32(16)
        more = np.bincount(cells, minlength=CELLS)
        counts = more if counts is None else counts + more
    return counts


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a text and their weights, of unit length together."""
    cells = np.flatnonzero(counts)
    x = (1 + np.log(counts[cells])) * idf[cells]
    return cells, x / max(np.sqrt(x @ x), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Per-coordinate FTRL-proximal for a softmax; weights exist only as sums of gradients."""

    def __init__(self, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.05):
        self.z, self.n = np.zeros((CELLS, classes)), np.zeros((CELLS, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, cells=slice(None)) -> np.ndarray:
        z, n = self.z[cells], self.n[cells]
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, cells: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(cells)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[cells]
        grown = n + g * g
        self.z[cells] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[cells] = grown


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not LETTER(text):
            return UNKNOWN, 0.0
        cells, x = features(gram_counts(text), self.idf)
        p = softmax(x @ self.weights[cells] / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, to one per cent.

    The targets are smoothed by one imagined error, so that a sample without errors does
    not ask for certainty.
    """
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    wrong = 1 / (n + 2)
    target = np.full((n, k), wrong / (k - 1))
    target[np.arange(n), labels] = 1 - wrong
    grid = np.exp(np.arange(-4, 3, 0.01))
    loss = [-(target * np.log(np.maximum(softmax(logits / t), 1e-300))).sum() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_language_model(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
                       per_language: int = SAMPLE, epochs: int = 2) -> LanguageModel:
    """Learn from the rows where ``learn`` holds, the language is known and the text is not null."""
    rows = docs.filter(learn).select(F.col(quoted(text_col)).cast("string").alias("text"),
                                     F.col(quoted(lang_col)).cast("string").alias("lang")).dropna()
    # copies are one text, however many
    hashed = spread(rows).withColumn("at", F.xxhash64("text", F.lit(7)))
    distinct = {r["lang"]: r["texts"] for r in hashed.groupBy("lang").agg(F.approx_count_distinct("at").alias("texts")).collect()}
    languages = sorted(distinct)

    def cells_of(batches):
        df, n = np.zeros(CELLS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                df += gram_counts(text) > 0
                n += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(df[used], n))], ["cell", "df"])

    df, n = np.zeros(CELLS), 0
    for r in spread(rows.select("text")).mapInArrow(cells_of, "cell long, df long").groupBy("cell").agg(F.sum("df").alias("df")).collect():
        if r["cell"] < 0:
            n = r["df"]
        else:
            df[r["cell"]] = r["df"]
    idf = np.log((1 + n) / (1 + df)) + 1

    # ranked are only the hashes below a bound that leaves several times the limit, so no task gets more of a
    # large language; a language of at most 64 texts, or of four times the limit, has no bound
    limit = max(1, min(per_language, MOST // max(1, len(languages))))
    room = max(4 * limit, 64)
    bounds = [x for k, n in distinct.items() for x in (
        F.lit(k), F.lit(min(2 ** 63 - 1, int(2 ** 64 * min(1.0, room / max(n, 1))) - 2 ** 63)).cast("long"))]
    low = hashed.select("lang", "at").filter(F.col("at") <= F.create_map(*bounds)[F.col("lang")]) if bounds else hashed.select("lang", "at")
    drawn = low.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("at"))).filter(
        F.col("rank") <= limit).drop("rank")

    def counts_of(batches):
        met = set()
        for batch in batches:
            new = [i for i, own in enumerate(zip(batch.column("lang").to_pylist(), batch.column("at").to_pylist()))
                   if not (own in met or met.add(own))]
            batch = batch.take(pa.array(new, pa.int64()))
            cells, counts = [], []
            for text in batch.column("text").to_pylist():
                dense = gram_counts(text)       # half a megabyte, so of one text at a time
                used = np.flatnonzero(dense)
                cells.append(used.astype(np.uint16).tobytes())
                counts.append(dense[used].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("lang"), batch.column("at"), pa.array(cells, pa.binary()), pa.array(counts, pa.binary())],
                ["lang", "at", "cells", "counts"])

    sample = (hashed.join(F.broadcast(drawn), ["lang", "at"])
              .mapInArrow(counts_of, "lang string, at long, cells binary, counts binary")
              .groupBy("lang", "at").agg(F.first("cells").alias("cells"), F.first("counts").alias("counts")).collect())
    sample.sort(key=lambda r: (r["at"], r["lang"]))
    data = []
    for r in sample:
        counts = np.zeros(CELLS, np.int64)
        counts[np.frombuffer(r["cells"], np.uint16)] = np.frombuffer(r["counts"], np.uint32)
        data.append((*features(counts, idf), languages.index(r["lang"])))
    held, taught, nth = [], [], Counter()
    for x in data:      # the fifth of each language, so that one of few texts is taught
        nth[x[2]] += 1
        (taught if nth[x[2]] % 5 else held).append(x)
    model = Ftrl(len(languages))
    for _ in range(epochs):
        for cells, x, label in taught:
            model.learn(cells, x, label)
    weights = model.weights()
    logits = np.array([x @ weights[cells] for cells, x, _ in held]).reshape(len(held), len(languages))
    temperature = fit_temperature(logits, np.array([label for *_, label in held], np.int64)) if languages else 1.0
    return LanguageModel(languages, idf.astype(np.float32), weights.astype(np.float32), temperature)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", pred_col: str = "lang_pred",
             score_col: str = "lang_score") -> DataFrame:
    """``docs`` with the language and its score added (all other columns stay); their names must be free."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = StructType(list(docs.schema.fields)).add(pred_col, "string").add(score_col, "double")
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for batch in batches:
            found = [m.predict(t.as_py()) for t in batch.column(at)]       # one text at a time
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=out.names)

    # by position, for a name may hold dots
    return spread(docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])).mapInArrow(run, out)


def languages_of(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score. The text does not leave the task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = spread(docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text")))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in batches:
            found = [m.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return source.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
