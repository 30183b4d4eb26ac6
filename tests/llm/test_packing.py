import array
import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tidemark.llm.packing import fill_sequences, pack, pack_documents, word_tokenizer  # noqa: E402

FILE = P.path("word_bpe_49k.json")


def test_ids_are_the_library_s():
    library = tokenizers.Tokenizer.from_file(FILE)
    rnd = random.Random(3)
    texts = ["Hello World's don't <|endoftext|> A<|startoftext|>b <|ENDOFTEXT|>", "Straße İstanbul ΣΑΣ", "J̌ ẍ é", "a\x1cb",
             "don't,, he'll!! 's ''s", "日本 ½ ²", "a b c\x85d", "", "ªº ſ Ⱥ", "A.B,c-d's(e)", "x" * 3000]
    texts += ["".join(rnd.choice("abcAB  't.!,<|>\n1é²ÉΣ") for _ in range(150)) for _ in range(500)]
    for t in texts + texts:
        assert list(array.array("I", word_tokenizer(FILE).encode(t))) == library.encode(t, add_special_tokens=False).ids, t


def test_each_id_is_in_one_piece_and_sequences_hold(docs):
    library = tokenizers.Tokenizer.from_file(FILE)
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["cat", "dog", "zyzzy", "Q"]) for _ in range(rnd.randrange(200)))) for i in range(200)]
    rows += [(200, None), (201, ""), (202, "word " * 3000)]
    got = pack_documents(docs(rows), FILE, 64, max_segments=5, keep_ids=True).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        ids, at = library.encode(text or "", add_special_tokens=False).ids + [2], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids"]) == (at, len(ids), part)
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 64 and len(own) <= 5


def test_every_limit_holds_and_the_heuristic_fills():
    rng = np.random.default_rng(2)
    sizes = np.column_stack([rng.integers(0, 90, 500), np.ones(500, int), rng.integers(0, 40, 500)])
    limits = np.array([100, 8, 60])
    number = fill_sequences(sizes, limits)
    for s in range(number.max() + 1):
        assert (sizes[number == s].sum(0) <= limits).all()
    assert number.max() + 1 <= 1.15 * max(sizes.sum(0) / limits)


def test_instruction_data_with_fewer_loss_tokens(spark):
    items = spark.createDataFrame([(i, 10 + i % 50, i % 20) for i in range(300)] + [(300, None, None)], "id int, tokens int, loss int")
    got = pack(items, 128, 6, 40, group=64).groupBy("sequence_id").agg({"tokens": "sum", "loss": "sum", "id": "count"}).collect()
    assert sum(r["count(id)"] for r in got) == 301
    assert all(r["sum(loss)"] is None or (r["sum(tokens)"] <= 128 and r["sum(loss)"] <= 40 and r["count(id)"] <= 6) for r in got)


def test_too_large_items_are_refused(spark):
    with pytest.raises(Exception, match="larger than a sequence"):
        pack(spark.createDataFrame([(5, 9)], "tokens int, loss int"), 10, 2, 8).collect()


def test_empty_table(docs):
    assert pack_documents(docs([]).filter("false"), FILE, 64).count() == 0


def test_short_documents_fill_their_sequences(docs):
    """Padding counts up to the limit, but a sequence whose length is a power of two has none."""
    for text, n in (("cat dog", 3000), ("", 1500)):
        lengths = {}
        for r in pack_documents(docs([(i, text) for i in range(n)]), FILE, 512).collect():
            lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
        total = sum(lengths.values())
        padded = sum(0 if m & (m - 1) == 0 else 512 - m for m in lengths.values())
        assert max(lengths.values()) <= 512 and len(lengths) <= -(-total // 510) and padded <= 512


def test_groups_of_short_items_hold_many_sequences(spark):
    items = spark.range(60_000).selectExpr("id", "2 as tokens", "2 as loss", "'x' as __group")
    got = pack(items, 256, 256, 256, group=100)
    assert got.columns == ["id", "tokens", "loss", "__group", "sequence_id", "offset"]
    assert got.select("sequence_id").distinct().count() <= 1.01 * 60_000 * 2 / 256 + 2
