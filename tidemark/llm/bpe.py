"""Byte-level BPE by per-prefix dynamic programming.

The merges of a vocabulary give every byte string one encoding. For each prefix of a
pre-token exactly one token can be the last of that prefix's encoding, and it is found
without replaying merges: a suffix automaton over all tokens lists those that end at a
position, longest first, and a token is the last one when the last token of the prefix
before it may stand to its left. Two tokens may stand side by side when the merges never
join anything across the seam between them. Following the last tokens back from the end
gives the ids.

Text outside pre-tokens does not exist: the pattern covers every character, and the
special tokens are cut out first. Encodings are kept per distinct pre-token, in two
tables of bounded size of which the older is dropped when the younger is full, so memory
is bounded and results do not depend on it.

Defined cases: a null text counts as empty and has no ids (the digests are those of no
bytes). Texts of any length are encoded whole; a pre-token costs time in proportion to
its length. Repeated rows and ids give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .automaton import Automaton
from .common import id_text, sha256_hex, spread, texts

# The public byte-level pattern, and the bytes that stand for themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

KEPT_PRETOKENS = 400_000
PREFIX = 6              # bytes of a pre-token whose table of last tokens is shared
NEVER = 1 << 60


def byte_chars() -> dict[str, int]:
    """Character to byte of the byte-level alphabet: the other bytes follow from U+0100 on."""
    rest = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}


class Uneven(Exception):
    """White space beside a space."""


class TokenAutomaton(Automaton):
    """All substrings of a set of words; each word's state knows the word.

    Following the bytes of a text, with suffix links where no transition is left, the state
    stands for the longest suffix read that still is a substring of some word. ``word`` has
    the word that is a state's longest string, ``up`` the nearest state on the suffix links
    that has one, so the words ending at a position are a short chain.
    """

    def __init__(self, words: dict[bytes, int]):
        super().__init__()
        word = {self.add(text): number for text, number in words.items()}
        self.word = [word.get(s, -1) for s in range(len(self.link))]
        self.up = [0] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            above = self.link[s]
            self.up[s] = above if above <= 0 or self.word[above] >= 0 else self.up[above]


class ByteBpe:
    """A vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(chars[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            joined = vocab[a + b]
            self.rank[vocab[a], vocab[b]] = r
            self.parts.setdefault(joined, (vocab[a], vocab[b], r))
        made = {self.bytes_of[i]: i for i in vocab.values() if i in self.parts or self.length[i] == 1}
        self.automaton = TokenAutomaton(made)
        self.split = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.prefixes: dict[bytes, tuple[list[int], int, int]] = {}
        flat = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.flat = np.frombuffer(b"".join(flat), np.uint8)
        self.sizes = np.array([len(b) for b in flat], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge of ``token`` from its last byte up, each with the rank that ends it."""
        spine = self.spines.get((token, side))
        if spine is None:
            spine, end, t = [], NEVER, token
            while True:
                spine.append((t, end))
                if t not in self.parts:
                    break
                end = self.parts[t][2]
                t = self.parts[t][side]
            spine.reverse()
            self.spines[token, side] = spine
        return spine

    def fits(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` and ``b`` together is encoded as these two."""
        known = self.pairs.get((a, b))
        if known is None:
            left, right, rank = self._spine(a, 1), self._spine(b, 0), self.rank
            i = j = 0
            known = True
            while True:
                (x, x_end), (y, y_end) = left[i], right[j]
                # of equal merges the leftmost comes first: the seam loses against x's own, wins against y's
                r = rank.get((x, y))
                if r is not None and r < x_end and r <= y_end:
                    known = False
                    break
                if x_end == y_end == NEVER:
                    break
                if x_end <= y_end:
                    i += 1
                else:
                    j += 1
            self.pairs[a, b] = known
        return known

    def _prefix(self, text: bytes, last: list[int], state: int, size: int) -> tuple[list[int], int, int]:
        """Extend the last tokens of the prefixes of ``text`` from those that ``last`` has to all."""
        auto, pairs = self.automaton, self.pairs
        nexts, link, length, word, up = auto.next, auto.link, auto.length, auto.word, auto.up
        end = len(last) - 1
        last = last + [-1] * (len(text) - end)
        for byte in text[end:]:
            end += 1
            while state and byte not in nexts[state]:
                state = link[state]
                size = length[state]
            to = nexts[state].get(byte)
            if to is not None:
                state = to
                size += 1
            # the words that end here, longest first
            s = state if word[state] >= 0 and size == length[state] else up[state]
            while s > 0:
                start, t = end - length[s], word[s]
                if not start:
                    last[end] = t
                    break
                before = last[start]
                if before >= 0:
                    fit = pairs.get((before, t))
                    if self.fits(before, t) if fit is None else fit:
                        last[end] = t
                        break
                s = up[s]
        return last, state, size

    def word_ids(self, text: bytes) -> list[int]:
        """Ids of one pre-token."""
        head = text[:PREFIX]
        begun = self.prefixes.get(head)
        if begun is None:
            if len(self.prefixes) >= KEPT_PRETOKENS:
                self.prefixes.clear()
            begun = self.prefixes[head] = self._prefix(head, [-1], 0, 0)
        last = begun[0] if len(text) <= PREFIX else self._prefix(text, *begun)[0]
        ids, at, length = [], len(text), self.length
        while at:
            ids.append(last[at])
            at -= length[ids[-1]]
        return ids[::-1]

    def _pretoken(self, word: str) -> bytes:
        return array("I", self.word_ids(word.encode("utf-8", "replace"))).tobytes()

    def _chunk(self, word: str, space: str = " ") -> bytes:
        """Ids of what stands between two spaces, with the space before it."""
        ids = self.old.get(word) if space else None
        if ids is None:
            if word.isalpha():
                ids = self._pretoken(space + word)
            else:
                ids = b"".join([self._pretoken(w) for w in self.split(space + word)])
        if space and word and not word[0].isspace() and not word[-1].isspace():
            if len(self.young) >= KEPT_PRETOKENS:
                self.young, self.old = {}, self.young
            self.young[word] = ids
        elif space:
            raise Uneven
        return ids

    def _plain(self, part: str) -> list[bytes]:
        """Encodings in the order of the text.

        A space between two visible characters always starts a pre-token, so the text is
        cut there. Any other white space beside a space goes the way of the pattern.
        """
        head, *rest = part.split(" ")
        if rest and head and head[-1].isspace():
            return [self._pretoken(w) for w in self.split(part)]
        try:
            out = [self._chunk(head, "")] if head else []
            for w in rest:
                out.append(self.young.get(w) or self._chunk(w))
            return out
        except Uneven:
            return [self._pretoken(w) for w in self.split(part)]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.pairs) >= 4 * KEPT_PRETOKENS:
            self.pairs.clear()
        out: list[bytes] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
            elif part:
                out += self._plain(part)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, np.uint32)
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        if not len(ends):
            return ""
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        at += np.arange(ends[-1])
        return self.flat[at].tobytes().decode("utf-8", "replace")


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """One per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``keep_ids`` also ids and decoded."""
    source = spread(id_text(docs, id_col, text_col))
    id_type = source.schema["doc_id"].dataType.simpleString()
    extra = ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches):
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            ids = [bpe.encode(t) for t in texts(batch)]
            decoded = [bpe.decode(x) for x in ids]
            cols = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(map(sha256_hex, ids), pa.string()),
                    pa.array([sha256_hex(t.encode()) for t in decoded], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols += [pa.array([array("i", x) for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return source.mapInArrow(run, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")
