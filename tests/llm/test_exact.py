import hashlib
import random

from tidemark.llm import exact
from tidemark.llm.exact import DigestIndex, buckets_for, drop_copies, exact_dedup

STRIP = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(STRIP), []).append((-len(t or ""), i is None, i))
    return {i: (min(g)[2], len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for *_, i in g}


def test_against_brute_force(docs, by_id):
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choice("ab \n\t é") for _ in range(rnd.randrange(5)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "x" * 300_000), (303, "x" * 150_000 + " " + "x" * 150_000)]
    got = by_id(exact_dedup(docs(rows)))
    assert {i: (r["keep_id"], r["group_size"], r["text_sha256"]) for i, r in got.items()} == brute(rows)
    assert all(r["kept"] == (r["keep_id"] == i) for i, r in got.items())


def test_null_ids_and_repeated_rows(docs):
    rows = exact_dedup(docs([(None, "a"), (5, "a"), (7, "b"), (7, "b"), (None, "cc"), (8, "c c ")])).collect()
    assert len(rows) == 6 and sum(r["kept"] for r in rows) == 3
    assert sorted((r["keep_id"] for r in rows if r["group_size"] == 2 and r["kept"])) == [5, 7, 8]


def test_empty_table(docs):
    assert exact_dedup(docs([]).filter("false")).count() == 0
    assert drop_copies(docs([]).filter("false")).count() == 0


def test_second_batch_is_matched_against_the_index(spark, docs, by_id, path):
    where = path("index")
    index = DigestIndex(spark, where, buckets=4)
    index.add(docs([(1, "one"), (2, "two")])).collect()
    index.close()
    again = DigestIndex(spark, where, buckets=4)
    got = by_id(again.add(docs([(3, "t w o"), (4, "three"), (5, "three")])))
    assert (got[3]["keep_id"], got[3]["kept"]) == (2, False)
    assert (got[4]["kept"], got[5]["kept"], got[5]["keep_id"]) == (True, False, 4)
    assert again.rows().count() == 3
    again.close()


def test_drop_copies_keeps_columns_and_one_of_equal_rows(docs):
    frame = docs([(1, "a b"), (2, "ab"), (3, "c"), (3, "c"), (4, None)])
    out = drop_copies(frame)
    assert out.columns == frame.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4]


def test_the_index_is_joined_by_sort_and_merge(spark, docs):
    index = DigestIndex(spark, buckets=4)
    plan = docs(["a"]).selectExpr("cast(text as binary) digest").hint("merge").join(index.rows(), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    index.close()
    assert "SortMergeJoin" in text and "Bucketed: true" in text


def test_buckets_follow_the_rows():
    assert [buckets_for(n) for n in (0, 1, 32 << 20, (32 << 20) + 1, 10**10)] == [32, 32, 32, 64, 16384]


def test_an_index_sizes_itself_and_is_folded(spark, docs, by_id, monkeypatch):
    monkeypatch.setattr(exact, "LEAST_BUCKETS", 1)
    monkeypatch.setattr(exact, "BUCKET_ROWS", 4)
    index = DigestIndex(spark)
    for at in range(0, 30, 10):
        index.add(docs([(i, f"text {i % 25}") for i in range(at, at + 10)])).collect()
    assert index.buckets == 4 and index.rows().count() == 25
    small = index.folded()
    assert small.buckets == 8 and len(small.rows().inputFiles()) <= 8 < len(index.rows().inputFiles())
    assert sorted(map(tuple, small.rows().collect())) == sorted(map(tuple, index.rows().collect()))
    got = by_id(small.add(docs([(90, "text 3"), (91, "new")])))
    assert (got[90]["keep_id"], got[90]["kept"], got[91]["kept"]) == (3, False, True)
    index.close()
    small.close()
