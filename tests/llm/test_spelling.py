import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(rows):
    """Occurrences as the contract words them."""
    seen = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            seen[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def forms(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def got(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def vocabulary(seed, size, letters):
    rng = random.Random(seed)
    n = {}
    while len(n) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 9)))
        n[w] = 5 ** rng.randint(1, 7) + rng.randint(0, 3)
    return n


@pytest.mark.parametrize("crowd, letters", [(256, "abcé"), (2, "abcé"), (1, "aÿz÷bq"), (4, "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß×÷")])
def test_pairs_at_every_level_against_all_pairs(spark, monkeypatch, crowd, letters):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (crowd,))
    n = vocabulary(crowd, 250, letters)
    rng = random.Random(1)
    for w in list(n)[:60]:
        i = rng.randrange(len(w))
        n.setdefault(w[:i] + rng.choice(letters) + w[i + rng.randint(0, 1):], rng.randint(5, 40))
    long = "".join(rng.choice(letters) for _ in range(5000))
    n |= {long: 5, long[:2500] + long[2501:]: 30, long + "a": 200, "a" * 300: 6, "a" * 301: 40}
    n = {w: c for w, c in n.items() if len(w) >= 6}
    frame = spark.createDataFrame([(w, c - 2) for w, c in n.items()] + [(w, 2) for w in n], "word string, n long").repartition(3)
    assert got(spelling.spelling_forms(frame)) == forms(n)


def test_words_of_whole_texts(spark, docs):
    rng = random.Random(3)
    stock = ["".join(rng.choice("abcdeéñÀÖ") for _ in range(rng.randint(4, 9))) for _ in range(120)]
    rows = [(i, rng.choice([" ", "\n", "–", "1"]).join(rng.choice(stock).title() for _ in range(rng.randint(0, 900)))) for i in range(40)]
    rows += [(1, "aaaaaa " * 9), (1, "aaaaaa " * 9), (2, None), (None, "bbbbbb " * 5 + "İİİİİİ ĀĀĀĀĀĀĀ \U0001f600"), (3, ""), (4, "x" * 300_000 + " ")]
    frame = docs(rows, extra="word")
    assert {r["word"]: r["n"] for r in spelling.word_occurrences(frame, 6).groupBy("word").sum("n").toDF("word", "n").filter("n >= 5").collect()} == words_of(rows)
    assert got(spelling.variants(frame)) == forms(words_of(rows))
    assert spelling.variants(docs([])).count() == 0 and spelling.variants(docs([None, "", "short 1"])).count() == 0


def test_counts_are_handed_on_when_there_are_many(spark, docs, monkeypatch):
    rows = [(i, f"word{'abcdef'[i % 6]}abc wordxyz") for i in range(200)]
    counted = spelling.word_occurrences(docs(rows), 6)
    assert {r["word"]: r["n"] for r in counted.groupBy("word").sum("n").toDF("word", "n").filter("n >= 5").collect()} == words_of(rows)


def test_long_chains_of_forms_reach_their_root(spark):
    n = {"abcdefghij"[:i] + "z" * (10 - i): 5 * 5 ** (10 - i) for i in range(11)}
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got(spelling.spelling_forms(frame)) == forms(n)
