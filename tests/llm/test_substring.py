import hashlib
import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import substring
from tidemark.llm.substring import COLUMNS, cut_repeats, judge, without_repeats



def brute(rows, n):
    """n_words, n_removed and hash of the kept words, per row."""
    seen, out = set(), {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        i, text = rows[k]
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            key = tuple(w[s:s + n])
            if key in seen:
                gone[s:s + n] = [True] * n
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[k] = (i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted(out.values(), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=repr)


def corpus(n_docs=150, seed=2):
    rnd = random.Random(seed)
    shared = [" ".join(f"s{rnd.randrange(900)}" for _ in range(rnd.randrange(10, 40))) for _ in range(6)]
    rows = []
    for i in range(n_docs):
        parts = [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(0, 50))) for _ in range(3)]
        parts.insert(rnd.randrange(4), rnd.choice(shared))
        if i % 10 == 0:
            parts += [parts[0]] * 2
        rows.append((i * 7 % 1000, rnd.choice([" ", "\n", " \t"]).join(parts)))
    return rows + [(2000, None), (2001, " \n"), (2002, "é" * 9), (2003, rows[3][1]), (2004, "a b " * 5000), (2005, "a\x0bb\x0c" * 60 + " a")]


@pytest.mark.parametrize("block, shard, hashes, stream", [(4 << 20, 50_000, 1 << 21, 200_000), (1500, 90, 400, 60)])
def test_against_brute_force(spark, docs, monkeypatch, block, shard, hashes, stream):
    rows = corpus()
    frame = docs(rows)
    for name, value in (("HASHES_PER_TASK", hashes), ("STREAM_WORDS", stream)):
        monkeypatch.setattr(substring, name, value)
    if block == 1500:       # small blocks and shards: many automata, cuts at their edges
        make, shards = substring.make_blocks, substring.Windows.__init__
        monkeypatch.setattr(substring, "BLOCK_BYTES", block)
        monkeypatch.setattr(substring, "SHARD_WORDS", shard)
        assert make and shards
    assert found(cut_repeats(frame, 8, with_text=False)) == brute(rows, 8)


def test_empty_table_null_ids_and_repeated_rows(docs):
    text = " ".join(map(str, range(30)))
    assert cut_repeats(docs([]).filter("false")).count() == 0
    rows = [(1, text), (1, text), (None, text), (2, "short text")]
    assert found(cut_repeats(docs(rows), with_text=False)) == brute(rows, 20)


def test_text_that_stays(docs, by_id):
    a, b = " ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25))
    frame = docs([(1, f"{a}\nfirst"), (2, f"one\n\n{a}  two\n{b}"), (3, b), (4, "clean  text "), (5, "")])
    out = without_repeats(frame)
    got = by_id(out)
    assert out.columns == frame.columns and set(got) == {1, 2, 4, 5}
    assert (got[2]["text"], got[2]["n_chars"]) == (f"one\n\ntwo\n{b}", len(f"one\n\ntwo\n{b}"))
    assert got[4]["text"] == "clean  text " and got[1]["text"] == f"{a}\nfirst"


def span(kind, doc_id, row, start, words):
    return dict.fromkeys(COLUMNS) | {"kind": kind, "block": 0, "doc_id": doc_id, "row": row, "start": start, "body": " ".join(words)}


def test_the_automaton_refuses_what_is_not_earlier():
    w = [f"w{i}" for i in range(12)]
    pdf = pd.DataFrame([span(0, 5, 0, 3, w), span(1, 6, 1, 0, w[2:9]), span(1, 6, 1, 20, w[:4] + ["x"] + w[5:8]),
                        span(1, 4, 2, 0, w[:6]), span(1, 5, 0, 3, w[:5]), span(1, 5, 0, 30, w[:5])])
    assert sorted(judge(pdf, 5)) == sorted([(0, 1, s) for s in (20, 21, 22, 23)] + [(0, 2, 0), (0, 2, 1), (0, 0, 3)])


def test_refused_windows_are_cut_again(spark):
    text = [b" ".join(b"w%d" % i for i in range(12)), b"x y z u v w"]
    blocks = spark.createDataFrame([(7, bytearray(substring._pack_texts(text)))], "block long, texts binary")
    told = [substring.result_row(r, r + 50, t, np.array(s), 4, True) for r, (t, s) in enumerate(zip(text, ([0, 1, 8], [1])))]
    names = ["block", "row", "doc_id", "n_words", "n_removed", "sha", "own_sha", "starts", "body"]
    results = spark.createDataFrame([tuple((t | {"block": 7})[c] for c in names) for t in told],
                                    "block long, row long, doc_id long, n_words long, n_removed long, sha string, own_sha string, "
                                    "starts binary, body string")
    refused = spark.createDataFrame([(7, 0, 1), (7, 0, 8)], "block long, row long, start long")
    got = {r["row"]: r for r in substring._cut_again(results, blocks, refused, 4, True).collect()}
    assert (got[0]["n_removed"], got[0]["body"]) == (4, text[0].decode()[12:]) and got[1]["n_removed"] == 4


def test_block_numbers_of_any_number_of_partitions(docs, monkeypatch):
    """Blocks numbered from 2^44 on, as those of 2^24 partitions would be."""
    monkeypatch.setattr(substring, "BLOCKS_PER_PARTITION", 1 << 44)
    monkeypatch.setattr(substring, "BLOCK_BYTES", 1500)
    rows = corpus(60)
    assert found(cut_repeats(docs(rows), 8, with_text=False)) == brute(rows, 8)
    assert (1 << 28) * (1 << 20) * substring.SHARDS_PER_BLOCK <= 1 << 63


def test_blocks_beyond_the_numbers_are_refused(docs, monkeypatch):
    monkeypatch.setattr(substring, "BLOCKS_PER_PARTITION", 2)
    monkeypatch.setattr(substring, "BLOCK_ROWS", 1)
    with pytest.raises(Exception, match="smaller partitions"):
        substring.make_blocks(docs(["a"] * 50).select("doc_id", "text")).collect()


def asked(n, blocks, part=0):
    """What blocks ask of a part: n hashes each, half of them shared with the next block."""
    rows = []
    for b in range(blocks):
        own = np.concatenate([np.arange(n // 2) + b * n, np.arange(n // 2) + (b + 1) * n]).astype(np.uint64)
        hashes = np.unique(substring.word_hashes(b" ".join(b"%d" % x for x in own), substring.BREAKS)[0])
        seven = (hashes >> np.uint64(8)).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()
        places = np.full(len(hashes), 1000 - b).tobytes(), np.arange(len(hashes)) // 500
        rows.append({"part": part, "block": b + 1, "hashes": seven, "places": substring._pack(
            np.diff(np.frombuffer(places[0], np.int64), prepend=0).tobytes() + np.diff(places[1], prepend=0).tobytes())})
    return pd.DataFrame(rows)


def homes_of(pdf):
    return [np.frombuffer(substring._unpack(x), np.int64).tolist() for x in pdf["home"]]


@pytest.mark.parametrize("at_once", [1, 900, 1 << 20])
def test_answers_do_not_depend_on_how_many_hashes_are_sorted_at_a_time(monkeypatch, at_once):
    pdf = asked(1000, 5)
    monkeypatch.setattr(substring, "HASHES_AT_ONCE", at_once)
    got = homes_of(substring.answer(pdf))
    keys = [[h[i:i + 7] for i in range(0, len(h), 7)] for h in pdf["hashes"]]
    holders = {}
    for b, own in enumerate(keys):
        for i, k in enumerate(own):
            holders.setdefault(k, []).append((1000 - b, b + 1, i // 500))
    want = []
    for b, own in enumerate(keys):
        least = [min(holders[k]) for k in own]
        want.append([(-2 if len(holders[k]) > 1 else -1) if x[1] == b + 1 else x[1] * substring.SHARDS_PER_BLOCK + x[2]
                     for k, x in zip(own, least)])
    assert got == want and {-1, -2} < {x for own in got for x in own}


def test_answers_take_little_memory():
    pdf = asked(100_000, 10)
    tracemalloc.start()
    try:
        substring.answer(pdf)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 64 * 1_000_000
