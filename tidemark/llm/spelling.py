"""Spelling variants: words at one edit, found over a reduced alphabet.

Letters are hashed to a few symbols. Every reduced word generates its one-edit neighbourhood,
which is joined to the reduced vocabulary; what meets is verified on the original words. A
pair is generated from one side only: by deletion from the longer word, by replacement from
the word with the lower symbol, or by the reduced word itself. A neighbour is a 64-bit
polynomial hash of its symbols, so a word of any length costs a few operations per neighbour,
and a shared hash costs a verification, never a pair.

A reduced word that very many words share would make all their pairs candidates. Such words
go on to a finer alphabet, of which each symbol is a part of a coarser one, and at last to
the letters themselves, where a reduced word is one word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, importable, release, spread, staged, texts

# Letters are a-z and U+00C0 to U+00FF; only A to Z are lower-cased.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
LEVELS = (3, 5, 7)          # bits of a symbol: 8 symbols, 32, and a symbol for each of the 90 letters
CROWD = 256                 # words that may share a reduced word at one level
KEPT_WORDS = 1 << 18        # distinct words a task counts before it hands them on
LONG_WORD = 64              # longer words travel with their neighbours as a hash only
CELLS = 1 << 20             # neighbours made at once

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _separators() -> bytes:
    """Latin-1 bytes: letters in lower case where ASCII, blanks for all else."""
    table = bytearray(b" " * 256)
    for c in LETTERS:
        table[c] = c
    for c in range(0x41, 0x5B):
        table[c] = c + 32
    return bytes(table)


_TO_RUNS = _separators()


def _ranks() -> np.ndarray:
    """For each code point below 256 the 7-bit symbol of a letter; coarser symbols are its upper bits."""
    order = sorted(LETTERS, key=lambda c: zlib.crc32(b"letter %d" % c))
    ranks = np.zeros(256, np.uint64)
    ranks[order] = np.arange(len(order), dtype=np.uint64) * np.uint64(128) // np.uint64(len(order))
    return ranks


_RANKS = _ranks()
_USED = {bits: np.unique(_RANKS[LETTERS] >> np.uint64(7 - bits))[1:] + np.uint64(1) for bits in LEVELS}


def word_occurrences(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text", damage: int = 199) -> DataFrame:
    """word, n: how often each word of at least ``least`` letters occurs, as counted per task.

    Where ``damage`` divides the CRC-32 of ``<id>:<run>``, the run loses the letter at that
    number modulo its length; 0 damages none. A null id is an empty text there.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in seen], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(seen.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                # any code point beyond Latin-1 becomes a question mark, which is no letter
                runs = Counter([r for r in text.encode("latin-1", "replace").translate(_TO_RUNS).split(b" ") if len(r) >= least])
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run in [r for r in runs if damage and zlib.crc32(r if r.isascii() else r.decode("latin-1").encode(), start) % damage == 0]:
                    n, lost = runs.pop(run), zlib.crc32(run.decode("latin-1").encode(), start) % len(run)
                    if len(run) > least:
                        seen[run[:lost] + run[lost + 1:]] += n
                seen.update(runs)
                if len(seen) >= KEPT_WORDS:
                    yield flushed()
                    seen.clear()
        if seen:
            yield flushed()

    return spread(id_text(docs, id_col, text_col).filter(F.length("text") >= least)).mapInArrow(count, "word string, n bigint")


def _symbols(words: list[bytes], bits: int) -> np.ndarray:
    """A row of symbols (from 1) for each of some words of one length."""
    letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
    return (_RANKS[letters] >> np.uint64(7 - bits)) + np.uint64(1)


def _mixed(h: np.ndarray, length: int) -> np.ndarray:
    h = h ^ np.uint64(length * 0x2545F4914F6CDD1D & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def reduced_keys(words: list[bytes], bits: int) -> np.ndarray:
    """The hash of each reduced word, for words of one length."""
    s = _symbols(words, bits)
    with np.errstate(over="ignore"):
        return _mixed((s * _powers(s.shape[1])).sum(axis=1, dtype=np.uint64), s.shape[1])


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _BASE, np.uint64)]), dtype=np.uint64)


def neighbour_keys(words: list[bytes], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(row, key, whether it is the word's own) of the neighbourhoods of words of one length.

    Own keys, every deletion, and every replacement by a higher symbol; each once per word.
    """
    s = _symbols(words, bits)
    rows, n = s.shape
    powers = _powers(n)
    with np.errstate(over="ignore"):
        terms = s * powers
        upto = np.cumsum(terms, axis=1, dtype=np.uint64)
        whole = upto[:, -1]
        yield np.arange(rows), _mixed(whole, n), True
        step = max(1, CELLS // (rows << bits))
        for at in range(0, n, step):
            to = min(n, at + step)
            part = s[:, at:to]
            if n > 1:
                # of a run of one symbol only the first deletion counts
                before = np.concatenate([np.zeros((rows, 1), np.uint64) if at == 0 else s[:, at - 1:at], part[:, :-1]], axis=1)
                row, col = np.nonzero(part != before)
                kept = upto[row, col + at] - terms[row, col + at]
                yield row, _mixed(kept + (whole[row] - upto[row, col + at]) * _INVERSE, n - 1), False
            for symbol in _USED[bits]:
                row, col = np.nonzero(part < symbol)
                yield row, _mixed(whole[row] + (symbol - part[row, col]) * powers[col + at], n), False


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Positions and words of one length, in pieces whose work fits in memory."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        piece = max(1, CELLS // int(n))
        for i in range(0, len(at), piece):
            yield at[i:i + piece], [words[j] for j in at[i:i + piece]]


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def reduced_vocabulary(words: DataFrame, bits: int) -> DataFrame:
    """key, word, n: the vocabulary under the hash of its reduced words."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoded = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            keys = np.zeros(len(encoded), np.uint64)
            for at, some in _by_length(encoded):
                keys[at] = reduced_keys(some, bits)
            yield pa.RecordBatch.from_arrays([_signed(keys), batch.column("word"), batch.column("n")], ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(keyed, "key bigint, word string, n bigint")


def neighbourhoods(words: DataFrame, bits: int) -> DataFrame:
    """key, own, word_id, word, n: every word under the hashes of its reduced neighbours.

    ``word`` is null for long words, which ``word_id``, a hash, then stands for.
    """
    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoded = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            for at, some in _by_length(encoded):
                long = len(some[0]) > LONG_WORD
                for row, keys, own in neighbour_keys(some, bits):
                    where = pa.array(at[row])
                    word = pa.nulls(len(row), pa.string()) if long else batch.column("word").take(where)
                    ids = batch.column("word_id").take(where) if long else pa.nulls(len(row), pa.int64())
                    yield pa.RecordBatch.from_arrays([_signed(keys), pa.array(np.full(len(row), own)), ids, word, batch.column("n").take(where)],
                                                     ["key", "own", "word_id", "word", "n"])

    with_id = words.select("word", "n", F.xxhash64("word").alias("word_id"))
    return with_id.mapInArrow(spread_out, "key bigint, own boolean, word_id bigint, word string, n bigint")


def near_pairs(vocabulary: DataFrame, crowd: int = CROWD) -> DataFrame:
    """word, n, near, near_n: every pair of a vocabulary at one edit, from one side."""
    sources = targets = vocabulary.select("word", "n")
    found = []
    for bits in LEVELS:
        keyed = staged(reduced_vocabulary(targets, bits), f"reduced{bits}")
        spread_keys = neighbourhoods(sources, bits)
        crowded = None
        if bits != LEVELS[-1]:
            crowded = staged(keyed.groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > crowd).select("key"), "crowded")
            if crowded.isEmpty():
                crowded = None
        near = keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
        if crowded is not None:
            near = near.join(crowded, "key", "left_anti")
        # the planner takes the neighbours for as few as the words: they must never be broadcast
        met = spread_keys.hint("merge").join(near, "key")
        one = (~F.col("own") | (F.col("word") < F.col("near"))) & (F.levenshtein("word", "near", 1) == 1)
        columns = ["word", "n", "near", "near_n"]
        found.append(met.filter(F.col("word").isNotNull() & one).select(*columns))
        known_long = sources.filter(F.length("word") > LONG_WORD).select("word", F.xxhash64("word").alias("word_id"))
        found.append(met.filter(F.col("word").isNull()).drop("word").join(known_long, "word_id").filter(one).select(*columns))
        if crowded is None:
            break
        targets = staged(keyed.join(crowded, "key", "left_semi").select("word", "n"), "targets")
        touched = neighbourhoods(sources, bits).join(crowded, "key", "left_semi")
        ids = touched.select(F.coalesce("word_id", F.xxhash64("word")).alias("word_id")).distinct()
        sources = staged(sources.withColumn("word_id", F.xxhash64("word")).join(ids, "word_id", "left_semi").select("word", "n"), "sources")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def spelling_forms(counted: DataFrame, least: int = 5, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n from ``word, n`` rows, whose counts are added up.

    Words of fewer than ``least`` occurrences do not count. A word's form is its near word of
    largest n (ties: smallest in code-point order) if that is at least ``ratio`` times its own
    n; the root is where the forms lead. No word gives no row.
    """
    importable(counted.sparkSession)
    vocabulary = staged(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "vocabulary")
    pairs = staged(near_pairs(vocabulary), "pairs")
    both = pairs.select("word", "near", "near_n").unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form"))).alias("best"))
    told = vocabulary.join(best, "word", "left")
    is_form = -F.col("best.m") >= ratio * F.col("n")
    told = staged(told.select("word", F.when(is_form, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                              F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
    release(pairs)
    links = told.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    # each round doubles the steps a link spans; n grows by the ratio at every step
    largest = told.agg(F.max("form_n")).first()[0] or 0
    steps = 1
    while least * ratio ** steps <= largest:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = staged(links.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "links")
        steps *= 2
    return told.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spelling variants among the words of six and more letters in whole texts.

    Null texts hold no words, a null id counts as empty in the hash that damages runs, and
    repeated rows count as often as they occur. Extra columns are not read.
    """
    return spelling_forms(word_occurrences(docs, 6, id_col, text_col))


# The same rows in DuckDB's SQL. Its edit distance compares bytes, so letters beyond ASCII are
# first mapped to other ASCII characters; pairs are found by the words' one-letter deletions.
SPELLING_SQL = """
    WITH RECURSIVE runs AS (
      SELECT doc_id, run, count(*) AS m FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
      WHERE length(run) >= 6 GROUP BY doc_id, run),
    bytes AS (SELECT run, m, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS b FROM runs),
    hashed AS (
      SELECT run, m, xor(4294967295, list_reduce(
          list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(b), 2), lambda i:
                      list_concat([('0x' || substr(b, i, 2))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
          lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END)) AS h FROM bytes),
    words AS (
      SELECT word, sum(m)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM hashed)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
    letters AS (SELECT string_agg(chr(192 + i::INT), '' ORDER BY i) AS wide, string_agg(chr(33 + i::INT), '' ORDER BY i) AS narrow FROM range(64) t(i)),
    shorter AS (
      SELECT DISTINCT word, n, translate(word, wide, narrow) AS plain, substr(word, 1, i - 1) || substr(word, i + 1) AS part
      FROM words, letters, unnest(range(1, length(word) + 2)) AS t(i)),
    pairs AS (
      SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b USING (part)
      WHERE a.word <> b.word AND levenshtein(a.plain, b.plain) = 1),
    best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM pairs GROUP BY word),
    told AS (
      SELECT w.word, CASE WHEN form_n >= 5 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
      FROM words w LEFT JOIN best USING (word)),
    steps AS (SELECT word, word AS root FROM told UNION ALL SELECT s.word, t.form FROM steps s JOIN told t ON t.word = s.root WHERE t.form IS NOT NULL),
    roots AS (SELECT s.word, s.root FROM steps s JOIN told t ON t.word = s.root WHERE t.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM told JOIN roots USING (word)"""
