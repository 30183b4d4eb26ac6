import array
import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tidemark.llm.bpe import byte_bpe, encode_decode  # noqa: E402

FILE = P.path("byte_bpe_50k.json")
ODD = ["", " ", "aaaaaaaaaaaaaaaa", "hello world's  \n\n x", "<|endoftext|>hi <|endoftext|>", "日本 😀", " " * 50, "\x00\x01é",
       "a " * 20, "x\t y", "trailing ", "\x1c\x85  z", "don't I'LL 12345", "=" * 40 + "-" * 9]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


def test_ids_are_the_library_s(library):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("abcet hinos\n.é日=-1' ") for _ in range(200)) for _ in range(300)] + ["q" * 3000]
    for _ in range(2):      # the second time from the tables
        for t in texts:
            assert list(array.array("I", byte_bpe(FILE).encode(t))) == library.encode(t, add_special_tokens=False).ids, t


def test_tables_of_bounded_size_change_nothing(library, monkeypatch):
    monkeypatch.setattr("tidemark.llm.bpe.KEPT_PRETOKENS", 5)
    text = "the cat sat on the mat, the dog ate the cat and that was that. " * 3
    assert list(array.array("I", byte_bpe(FILE).encode(text))) == library.encode(text, add_special_tokens=False).ids


def test_query_columns(docs, by_id, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (91, "ab " * 100_000)]
    got = by_id(encode_decode(docs(rows), FILE))
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids"] == ids
        assert got[i]["ids_sha256"] == hashlib.sha256(array.array("I", ids).tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i]["decoded"] == decoded and got[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_empty_table_and_repeated_rows(docs):
    assert encode_decode(docs([]).filter("false"), FILE).count() == 0
    assert encode_decode(docs([(1, "a"), (1, "a"), (None, "b")]), FILE, keep_ids=False).count() == 3
