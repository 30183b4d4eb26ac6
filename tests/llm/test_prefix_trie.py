import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie

KIND = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The nodes from plain lists."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [t for *_, t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + own[c][h:]
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)

    def leaves(node):
        return sum(map(leaves, children[node])) if children[node] else 1

    def saved(node):
        return (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(map(saved, children[node]))

    return sorted((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), leaves(node), saved(node),
                   hashlib.sha256(",".join(map(str, sorted(c for c in cs if len(full[c]) == len(node)))).encode()).hexdigest())
                  for node, cs in members.items())


def key(rows):
    return sorted(rows, key=repr)


def some(seed, convs=60, turns=6, words=("a", "b", "long text", None, "")):
    rng = random.Random(seed)
    out = []
    for _ in range(convs):
        c = rng.choice([rng.randint(0, 350), rng.randint(-40, 250)])
        for t in range(rng.randint(1, turns)):
            out.append((c, rng.choice([t, t, t, None, 2]), rng.choice(["user", "bot", None]), rng.choice(words)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_lists(spark, seed):
    rows = some(seed) + [(None, 1, "user", "nobody's"), (100, 0, "user", "hi"), (100, 0, "user", "hi")]
    frame = spark.createDataFrame([(*r, 7) for r in rows], KIND + ", depth long").repartition(3)
    assert key(got_nulls(prefix_trie.prefix_trie(frame))) == key(brute(rows))


def got_nulls(df):
    return [tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect()]


def test_shards_of_few_conversations_and_turns_give_the_same(spark, monkeypatch):
    whole = prefix_trie.shard_nodes
    monkeypatch.setattr(prefix_trie, "shard_nodes", lambda batches: whole(batches, conversations=3, turns=4))
    monkeypatch.setattr(prefix_trie, "END_BITS", 4)
    rows = some(11, convs=40, turns=5, words=("a", "b")) + [(7, t, "user", str(t % 3)) for t in range(30)] + [(8, t, "user", str(t % 3)) for t in range(30)]
    rows += [(900 + i, None, None, None) for i in range(60)]
    assert key(got_nulls(prefix_trie.prefix_trie(spark.createDataFrame(rows, KIND)))) == key(brute(rows))


def test_empty_tables(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], KIND)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], KIND)).count() == 0


def test_a_conversation_may_lose_all_its_turns(spark):
    alone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 3)
    rows = [(alone, 0, "user", "x"), (alone, 1, "bot", "y" * 100_000)]
    assert got_nulls(prefix_trie.prefix_trie(spark.createDataFrame(rows, KIND))) == [
        (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
