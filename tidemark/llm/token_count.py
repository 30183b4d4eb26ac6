"""Token counts under a unigram model, with forward scores shared along a trie.

A word is cut into the pieces whose log probabilities sum highest. The best sum over a
prefix depends on that prefix alone, so distinct words go into a trie, and each node
holds the best sum and the number of pieces of its prefix, computed once from the nodes
above it. A word's count is the one at its last node. Words are what stands between
white space, with a mark for the blank in front.

A character that no piece covers costs one piece per UTF-8 byte. The model is a list of
pieces by rank; a rank r (from 0) has a probability in proportion to 1 / (r + 1).

Defined cases: a null text counts as empty and has no words and no tokens. Of equally
good cuts the one with fewer pieces counts. A trie is given up when it is full and begun
anew, which changes no count. Repeated rows and ids give repeated rows; other columns
are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, spread, texts

BLANK = "▁"
NODES = 600_000
LONGEST_KEPT = 64       # longer words are counted without entering the trie


def piece_ranks(model: str) -> dict[str, float]:
    """Log probabilities of the pieces of a sentencepiece vocabulary, by its order."""
    from sentencepiece import SentencePieceProcessor

    vocab = SentencePieceProcessor(model_file=model)
    pieces = [vocab.id_to_piece(i) for i in range(vocab.get_piece_size())
              if not (vocab.is_control(i) or vocab.is_unknown(i) or vocab.is_byte(i) or vocab.is_unused(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -math.log(r + 1) - total for r, p in enumerate(pieces)}


class CountingTrie:
    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.worst = min(pieces.values(), default=0.0) - 1.0
        self._clear()

    def _clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best = [(0.0, 0)]
        self.terminal: dict[str, int] = {}

    def _forward(self, word: str, end: int, above: list[tuple[float, int]]) -> tuple[float, int]:
        """Best sum and minus the pieces of ``word[:end]`` from those of the shorter prefixes."""
        pieces = self.pieces
        size = len(word[end - 1].encode("utf-8", "replace"))
        score, count = above[end - 1]
        best = None if word[end - 1] in pieces else (score + self.worst * size, count - size)
        for start in range(max(0, end - self.longest), end):
            p = pieces.get(word[start:end])
            if p is not None:
                score, count = above[start]
                here = (score + p, count - 1)
                if best is None or here > best:
                    best = here
        return best

    def count(self, word: str) -> int:
        """Pieces of one word."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        marked = BLANK + word
        above = [(0.0, 0)]
        if len(marked) > LONGEST_KEPT:
            for end in range(1, len(marked) + 1):
                above.append(self._forward(marked, end, above))
            return -above[-1][1]
        node, child, best = 0, self.child, self.best
        for end, char in enumerate(marked, 1):
            below = child.get((node, char))
            if below is None:
                best.append(self._forward(marked, end, above))
                below = child[node, char] = len(best) - 1
            node = below
            above.append(best[node])
        self.terminal[word] = -best[node][1]
        if len(best) >= NODES:
            self._clear()
        return -above[-1][1]


_loaded: dict[str, CountingTrie] = {}


def counting_trie(model: str) -> CountingTrie:
    """One per Python worker and file."""
    if model not in _loaded:
        _loaded[model] = CountingTrie(piece_ranks(model))
    return _loaded[model]


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    source = spread(id_text(docs, id_col, text_col))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        trie = counting_trie(model)
        for batch in batches:
            n_words, n_tokens = [], []
            for text in texts(batch):
                words = text.split()
                get = trie.terminal.get
                n_words.append(len(words))
                n_tokens.append(sum([get(w) or trie.count(w) for w in words]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"])

    return source.mapInArrow(run, f"doc_id {id_type}, n_words bigint, n_tokens bigint")
