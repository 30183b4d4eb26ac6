"""Every registered query on small tables with nulls, repeats, long texts and extra columns, and on empty ones."""

import pytest

pytest.importorskip("public_tokenizers")

from tidemark.llm.queries import QUERIES  # noqa: E402

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, digest string, score double",
    "labels": "doc_id long, quality int, toxic int, stats string",
    "embeddings": "vec_id long, embedding array<float>, label int, rep long",
    "conversations": "conv_id long, turn long, role string, text string, depth long",
}
LONG = " ".join(f"word{i % 997}" for i in range(60_000))


def rows():
    texts = ["the cat sat on the mat " * 8, "der Hund und die Katze " * 9, None, "", "x@y.org +1 (743) 555-3824", LONG, "a", "the cat sat on the mat " * 8,
             "colour colour colour colour colour color", "\U0001f600 é", " \n", "MIT License"] * 2
    docs = [(i if i != 7 else None, t, ["en", "de", None][i % 3], "s", len(t or ""), "x", 0.5) for i, t in enumerate(texts)]
    docs += [docs[0], (None, None, None, None, None, None, None)]
    labels = [(i, i % 2, 0, "x") for i in range(20)] + [(None, 1, None, None), (3, None, None, None), (99, 1, 0, "y"), (4, 1, 0, "z")]
    vectors = [(i, [1.0, float(i % 3), 0.5], i % 2, i) for i in range(12)] + [(None, [1.0, 0.0, 0.0], 1, 1), (20, None, 1, 1), (21, [0.0, 0.0, 0.0], 1, 1),
                                                                              (22, [1.0, float("nan"), 0.0], 1, 1), (23, [1.0, 1.0], 1, 1)]
    talk = [(c, t, "user", f"turn {t % 2}", 1) for c in range(5) for t in range(3)] + [(None, 1, "user", "x", 1), (7, None, None, None, None), (7, None, None, None, None)]
    return {"documents": docs, "labels": labels, "embeddings": vectors, "conversations": talk}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for name, content in (("odd", rows()), ("empty", dict.fromkeys(TABLES, []))):
        out[name] = str(tmp_path_factory.mktemp(name))
        for t, kind in TABLES.items():
            spark.createDataFrame(content[t], kind).coalesce(1).write.parquet(f"{out[name]}/{t}.parquet")
    return out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_and_empty_tables(spark, folders, name):
    n = len(rows()["documents"])
    got = QUERIES[name](spark, folders["odd"]).collect()
    number = int(name[2:].partition("_")[0])
    if number in (2, 3, 4, 5, 6, 7, 9, 11):
        assert len(got) == n
    if number in (2, 6):
        assert {r["held_out"] for r in got} <= {True, False} and all(r["held_out"] is False for r in got if r["doc_id"] is None)
        assert all(0 <= r["score"] <= 1 for r in got)
    if number == 2:
        assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    if number == 6:
        assert {r["lang_pred"] for r in got} <= {"en", "de", "und"}
    if number == 8:
        assert len(got) == len(rows()["embeddings"])
    if number == 10:
        assert sum(r["length"] for r in got) == sum(r["doc_tokens"] for r in got if r["start"] == 0)
    assert QUERIES[name](spark, folders["empty"]).count() == 0
