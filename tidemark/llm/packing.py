"""Packing of token sequences by vector bin packing with the dot-product heuristic.

An item has a size in three dimensions: its tokens, one segment, and its loss-bearing
tokens. A sequence takes items under a limit for each. It is filled by always taking the
item with the largest dot product of its size and the room left (both as shares of the
limits) among those that fit, until none does.

A document longer than a sequence is cut: whole sequences first, then the rest as one
item. Items are dealt at random into groups of about GROUP, and each group is packed in
one task; only numbers go there, and a group wastes at most its last sequence.

Defined cases: a null or empty text is the end token alone. Items over a limit in the
loss dimension are refused (ValueError). Null sizes count as 0; an item without tokens
takes a segment and no room. A null id is an item like others; repeated rows and ids are
items of their own. An empty input gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .bpe import byte_chars
from .common import free_name, id_text, quoted, spread, staged_in_small_batches, texts

GROUP = 8192            # items packed in one task, unless they are short
FULL = 256              # sequences whose tokens a group holds at least
KEPT_PIECES = 400_000
END_TOKEN = 2
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~|"        # ASCII marks but ' and <, >, which begin or make up tokens
BEYOND = re.compile("[^\x00-\u02ff]|\u0130").search
SEPARATORS = "\x1c\x1d\x1e\x1f"       # split() takes these for white space, the tokenizer's pattern does not


def fill_sequences(sizes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Sequence number of each item; ``sizes`` has a row per item and a column per limit."""
    kinds, kind = np.unique(sizes, axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    order = np.argsort(kind, kind="stable")
    left = np.bincount(kind, minlength=len(kinds))
    taken = np.cumsum(left) - left
    share = kinds / limits
    out = np.empty(len(sizes), np.int64)
    sequence, placed = 0, 0
    while placed < len(sizes):
        room, free = np.ones(len(limits)), limits.copy()
        alive = np.flatnonzero(left)
        while True:
            alive = alive[(left[alive] > 0) & (kinds[alive] <= free).all(1)]
            if not len(alive):
                break
            k = alive[np.argmax(share[alive] @ room)]
            out[order[taken[k]]] = sequence
            taken[k] += 1
            left[k] -= 1
            placed += 1
            free = free - kinds[k]
            room = free / limits
        sequence += 1
    return out


def pack(items: DataFrame, max_tokens: int, max_segments: int, max_loss: int, group: int = GROUP) -> DataFrame:
    """``items`` (tokens, loss and any other columns) with sequence_id and offset added.

    ``offset`` is gapless from 0 in each sequence. Sequence ids are distinct, not dense.
    """
    n, tokens = items.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    # short items: a group holds the tokens of many sequences, for its last one is not full
    groups = max(1, min(-(-n // group), int(tokens) // (FULL * max_tokens)))
    key = free_name(items.columns, "__group")
    numbered = items.withColumn(key, (F.rand(17) * groups).cast("long"))
    schema = StructType(list(items.schema.fields)).add("sequence_id", "long").add("offset", "long")
    limits = np.array([max_tokens, max_segments, max_loss], np.int64)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens = pdf["tokens"].fillna(0).to_numpy(np.int64)
        sizes = np.column_stack([tokens, np.ones(len(pdf), np.int64), pdf["loss"].fillna(0).to_numpy(np.int64)])
        if (sizes > limits).any():
            raise ValueError("an item is larger than a sequence may be")
        number = fill_sequences(sizes, limits)
        order = np.argsort(number, kind="stable")
        before = np.cumsum(tokens[order]) - tokens[order]
        first = np.searchsorted(number[order], number[order])
        offset = np.empty(len(pdf), np.int64)
        offset[order] = before - before[first]
        out = pdf.drop(columns=key)
        return out.assign(sequence_id=(pdf[key].to_numpy() << 32) + number, offset=offset)

    return numbered.groupBy(quoted(key)).applyInPandas(run, schema)


class WordTokenizer:
    """A vocabulary of the tokenizers library that lower-cases and drops white space.

    Its tokens never span white space, nor the seam between letters and what follows
    them, so the library encodes each distinct piece once and texts are joined from
    these. Text beyond U+02FF, where lower-casing and composition are not settled letter
    by letter, goes to the library in pieces as it stands. Two tables of bounded size
    keep the pieces, as the older one is dropped when the younger is full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = {b: c for c, b in byte_chars().items()}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a lower-case word of letters: a pre-token, to which only the merges apply."""
        known = self.young.get(word) or self.old.get(word)
        if known is None:
            spelt = "".join(map(self.letters.__getitem__, word.encode()))
            known = array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()
        self.young[word] = known
        return known

    def _learn(self, piece: str, simple: bool) -> bytes:
        if simple and piece.isalpha():
            return self._letters(piece)
        ids = self.old.get(piece)
        if ids is None:
            head = piece.rstrip(MARKS)
            if simple and head.isalpha():
                tail = piece[len(head):]
                ids = self._letters(head) + (self.young.get(tail) or self._library(tail))
            else:
                ids = self._library(piece)
        self.young[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(c in text for c in SEPARATORS):
            return self._library(text)
        if len(self.young) >= KEPT_PIECES:
            self.young, self.old = {}, self.young
        # text with a special token in it stays as it stands, for these keep their case
        simple = "<|" not in text and (text.isascii() or not BEYOND(text))
        get, learn = self.young.get, self._learn
        return b"".join([get(p) or learn(p, simple) for p in (text.lower() if simple else text).split()])


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def token_pieces(docs: DataFrame, vocabulary: str, max_tokens: int, id_col: str = "doc_id", text_col: str = "text",
                 end_token: int = END_TOKEN, keep_ids: bool = False) -> DataFrame:
    """Each document's ids and the end token, cut into pieces of at most ``max_tokens``.

    doc_id, start, length, ids_crc32, doc_tokens, and with ``keep_ids`` the ids.
    """
    source = spread(id_text(docs, id_col, text_col))
    id_type = source.schema["doc_id"].dataType.simpleString()
    extra = ", ids array<int>" if keep_ids else ""
    end = array("I", [end_token]).tobytes()

    def run(batches):
        words = word_tokenizer(vocabulary)
        for batch in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for row, text in enumerate(texts(batch)):
                data = words.encode(text) + end
                n = len(data) // 4
                for at in range(0, n, max_tokens):
                    piece = data[4 * at:4 * (at + max_tokens)]
                    rows.append(row)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if keep_ids:
                        ids.append(array("i", piece))
            cols = [batch.column("doc_id").take(pa.array(rows, pa.int64()))] + [
                pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                cols, names = cols + [pa.array(ids, pa.list_(pa.int32()))], names + ["ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return source.mapInArrow(
        run, f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint{extra}")


def pack_documents(docs: DataFrame, vocabulary: str, max_tokens: int = 4096, max_segments: int | None = None,
                   max_loss: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                   keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence_id and offset; every token bears loss.

    Segments and loss-bearing tokens are as many as a sequence's tokens where no limit is given.

    A piece that fills a sequence is one. Its sequence id is odd, those of packed
    sequences are even.
    """
    pieces = staged_in_small_batches(token_pieces(docs, vocabulary, max_tokens, id_col, text_col, keep_ids=keep_ids), "pieces")
    whole = (pieces.filter(F.col("length") == max_tokens)
             .withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("long")))
    rest = pieces.filter(F.col("length") < max_tokens).withColumn("tokens", F.col("length")).withColumn("loss", F.col("length"))
    packed = pack(rest, max_tokens, max_segments or max_tokens, max_loss or max_tokens).drop("tokens", "loss")
    return whole.unionByName(packed.withColumn("sequence_id", F.col("sequence_id") * 2))
