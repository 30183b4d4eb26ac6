import random

import pytest

P = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")

from tidemark.llm import token_count  # noqa: E402
from tidemark.llm.token_count import BLANK, CountingTrie, count_tokens, piece_ranks  # noqa: E402

FILE = P.path("piece_bpe_32k.model")


def plain(word, pieces, worst):
    """Best cut of one word, on its own."""
    w, best = BLANK + word, [(0.0, 0)]
    for end in range(1, len(w) + 1):
        options = [(best[s][0] + pieces[w[s:end]], best[s][1] - 1) for s in range(end) if w[s:end] in pieces]
        if w[end - 1] not in pieces:
            size = len(w[end - 1].encode())
            options.append((best[end - 1][0] + worst * size, best[end - 1][1] - size))
        best.append(max(options))
    return -best[-1][1]


def words():
    rnd = random.Random(6)
    return ["", "hello", "日本語", "😀x", "q" * 100] + ["".join(rnd.choices("abcdethinos.é", k=rnd.randrange(1, 14))) for _ in range(800)]


def test_counts_like_each_word_on_its_own():
    pieces = piece_ranks(FILE)
    trie = CountingTrie(pieces)
    for w in words() + words():
        assert trie.count(w) == plain(w, pieces, trie.worst), w
    assert len(trie.best) < sum(map(len, words()))          # prefixes are shared


def test_a_full_trie_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_count, "NODES", 30)
    pieces = piece_ranks(FILE)
    trie = CountingTrie(pieces)
    assert [trie.count(w) for w in words()] == [plain(w, pieces, trie.worst) for w in words()]


def test_documents(docs, by_id):
    pieces = piece_ranks(FILE)
    worst = CountingTrie(pieces).worst
    rows = [(1, "hello hello there"), (2, None), (3, " \n"), (4, "abc " * 50_000), (5, "x　y")]
    got = by_id(count_tokens(docs(rows), FILE))
    for i, t in rows:
        own = (t or "").split()
        assert (got[i]["n_words"], got[i]["n_tokens"]) == (len(own), sum(plain(w, pieces, worst) for w in set(own) for _ in range(own.count(w))))
    assert count_tokens(docs([]).filter("false"), FILE).count() == 0
    assert count_tokens(docs([(1, "a"), (1, "a"), (None, "a")]), FILE).count() == 3
