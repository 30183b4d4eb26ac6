"""From raw documents to packed training sequences, in stages that each use one operator.

Every stage but the last returns the columns of ``documents``. Repeated rows, nulls and
empty texts are treated as the operators define them: a text without letters leaves in
the first stage, so no empty text goes further; of rows equal in id and text one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact, langid, minhash, packing, substring
from tidemark.llm.common import free_name, quoted, small_batches, staged, table
from tidemark.llm.queries import language_model, tokenizer_path

# The least score of a language that lets a document pass. Among the languages learnt here
# it refuses only what looks like none of them: one of four equally likely ones has 0.25.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language stay; one without letters has none."""
    pred, score = (free_name(docs.columns, c) for c in ("lang_pred", "lang_score"))
    with small_batches(spark):
        model = language_model(docs)
    known = langid.identify(docs, model, pred_col=pred, score_col=score)
    return known.filter((F.col(quoted(pred)) != langid.UNKNOWN) & (F.col(quoted(score)) >= LEAST_LANGUAGE_SCORE)).drop(pred, score)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return minhash.drop_near_copies(docs, 0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier go from the texts; a document of nothing else goes whole."""
    return substring.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' tokens in sequences of 4096."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 4096)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("packing", pack)]

# Trained models and tokenizers are beyond SQL; tests/llm compares the run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
