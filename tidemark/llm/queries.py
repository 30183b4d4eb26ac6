"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, langid, licences, minhash, packing, pii, prefix_trie, quality, spelling, substring, token_count, vectors
from .common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_licence_scan(spark, sf_dir):
    """Every line, paragraph and document that is a licence notice."""
    return licences.scan_licences(table(spark, sf_dir, "documents")).drop("unit_text")


ORACLES["op1_licence_scan"] = licences.scan_sql()


def remainder_is(m: int, k: int) -> Column:
    """Whether the CRC-32 of the document's id leaves ``k``; false for a null id, which is never held out."""
    return F.coalesce(crc_mod(F.col("doc_id"), m) == k, F.lit(False))


@query
def op2_quality(spark, sf_dir):
    """Every document's quality; rows whose remainder by 5 is 0, and null ids, teach nothing."""
    labels = table(spark, sf_dir, "labels").filter(crc_mod(F.col("doc_id"), 5) != 0)
    scored = quality.classify_quality(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", remainder_is(5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_minhash_dedup(spark, sf_dir):
    """Every document's class of near copies (weighted Jaccard of five-word shingles 0.8 or more)."""
    return minhash.near_classes(table(spark, sf_dir, "documents"), 0.8)


@query
def op4_exact_dedup(spark, sf_dir):
    """Every document: the row that stands for its text, and how many share it."""
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op4_exact_dedup"] = """
    WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS chars,
                 sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
               FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)"""


@query
def op5_bpe_roundtrip(spark, sf_dir):
    """Every document encoded and decoded."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), keep_ids=False)


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Learnt from the rows whose remainder by 3 is not 1; a row with a null id teaches nothing."""
    return langid.fit_language_model(docs, crc_mod(F.col("doc_id"), 3) != 1)


@query
def op6_language_id(spark, sf_dir):
    """Every document's language."""
    docs = table(spark, sf_dir, "documents")
    return langid.languages_of(docs, language_model(docs)).select(
        "doc_id", remainder_is(3, 1).alias("held_out"), "lang_pred", "score")


@query
def op7_token_counts(spark, sf_dir):
    """Every document's words and unigram tokens."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op8_embedding_dedup(spark, sf_dir):
    """Every vector's links of cosine 0.93 or more under its label, and its component."""
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"), 0.93)


@query
def op9_substring_dedup(spark, sf_dir):
    """Every document without the words of windows of 20 that occur earlier."""
    return substring.cut_repeats(table(spark, sf_dir, "documents"), 20, with_text=False)


@query
def op10_packing(spark, sf_dir):
    """Every document's tokens in sequences of at most 4096."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 4096)


@query
def op11_pii(spark, sf_dir):
    """Every document's personal data."""
    return pii.span_digests(pii.find_personal_data(table(spark, sf_dir, "documents")))


@query
def op12_conversation_trie(spark, sf_dir):
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_conversation_trie"] = prefix_trie.TRIE_SQL


@query
def op13_spelling_variants(spark, sf_dir):
    """Every word with its near words, its form and its root."""
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLES["op13_spelling_variants"] = spelling.SPELLING_SQL
