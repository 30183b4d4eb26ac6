"""Prefix trie of conversations: vertical bitmaps per shard, merged over shards by a shuffle.

A shard is a run of conversations that one task reads in the order of their ids. For each
(position, turn) it holds the bitset of the conversations with that turn there. From the
root's bitset the walk goes depth first: the lowest conversation left in a node names a turn,
the intersection of the node's bitset with that turn's posting is a child, and what remains
names the next one. Popcounts are member counts; the members that end at a node are its end
list. A shard is bounded in conversations and in turns; a longer conversation is cut, and the
next shard starts at the node it had reached.

A node is known over all shards by its depth and the exclusive or of 128-bit hashes of
(position, turn) along its path, which a window computes while it numbers the turns.

Sums over subtrees need no walk over the merged tree. Every node is represented by its
smallest member; a conversation represents the nodes of its path from some depth on, its
chain. A node's subtree is the rest of its representative's chain and the whole chains of
its other members, so one sum over members gives it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import importable, quoted, release, staged

SHARD_CONVERSATIONS, SHARD_TURNS = 4096, 1 << 17
END_BITS = 20               # one row holds at most the 2^20 ids of an end list that share the bits above
NODE = ["depth", "k1", "k2"]
ROOT_KEY = 0

_PARTIAL = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
                      ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("chars", pa.int64()), ("ends", pa.list_(pa.int64()))])
_PARTIAL_DDL = ("depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, conv_id bigint, n_convs bigint, chars bigint, "
                "ends array<bigint>")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, base, p, chars, digest: every turn with its number from 1 in its conversation.

    Null turns come first; equal turns are ordered by the digest of role and text. Null roles
    and texts are empty. Rows without a conversation id belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), (F.col("conv_id") - F.col("conv_id") % 100).cast("long").alias("base"),
        F.col("turn").alias("turn"), F.length(text).cast("long").alias("chars"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"))
    order = W.partitionBy("base", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    # hashing by the base alone serves the window and the later joins on the base as well
    return rows.repartition("base").withColumn("p", F.row_number().over(order).cast("long")).drop("turn")


def rebuilt_turns(own: DataFrame, head: Column | None = None, most: int = 5) -> DataFrame:
    """Every conversation's turns after its head was replaced by that of its base conversation.

    ``own`` are staged :func:`ordered_turns`. ``head`` is the number of turns replaced, at most
    ``most``; the base of c is c - c % 100 (remainder with the sign of c). Returns a row (position 0) for the conversation itself
    and one per turn: conv_id, position, length, chars, h1, h2 (hash of position and turn)
    and k1, k2 (the node that the turn leads to).
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6 if head is None else head
    heads = own.filter((F.col("conv_id") == F.col("base")) & (F.col("p") <= most)).groupBy("base").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("p", "chars", "digest"))), lambda t: F.struct(t["chars"], t["digest"])).alias("first"))
    convs = own.groupBy("base", "conv_id").agg(F.max("p").alias("n_own")).join(heads, "base", "left").withColumn("head", head.cast("int"))
    convs = convs.withColumn("first", F.coalesce(F.slice("first", F.lit(1), F.col("head")), F.expr("array()")))
    convs = convs.withColumn("n_first", F.size("first")).withColumn("length", F.col("n_first") + F.greatest(F.lit(0), F.col("n_own") - F.col("head")))
    own_rest = own.join(convs.select("base", "conv_id", "head", "n_first", "length"), ["base", "conv_id"]).filter(F.col("p") > F.col("head"))
    columns = ["base", "conv_id", "length", "position", "chars", "digest"]
    nothing = [F.lit(0).cast("long").alias("position"), F.lit(0).cast("long").alias("chars"), F.lit(None).cast("binary").alias("digest")]
    taken = convs.select("base", "conv_id", "length", F.posexplode("first").alias("at", "t"))
    rows = (convs.select("base", "conv_id", "length", *nothing)
            .unionByName(taken.select("base", "conv_id", "length", (F.col("at") + 1).cast("long").alias("position"), "t.chars", "t.digest"))
            .unionByName(own_rest.select("base", "conv_id", "length", (F.col("p") - F.col("head") + F.col("n_first")).cast("long").alias("position"), "chars", "digest"))
            .select(*columns))
    path = W.partitionBy("base", "conv_id").orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.col("position") == 0
    rows = rows.repartition("base").select(
        "base", "conv_id", F.col("length").cast("long").alias("length"), "position", "chars",
        F.when(start, F.lit(ROOT_KEY).cast("long")).otherwise(F.xxhash64("position", "digest")).alias("h1"),
        F.when(start, F.lit(ROOT_KEY).cast("long")).otherwise(F.xxhash64("digest", "position")).alias("h2"))
    return rows.select("conv_id", "length", "position", "chars", "h1", "h2",
                       F.bit_xor("h1").over(path).alias("k1"), F.bit_xor("h2").over(path).alias("k2"))


class Shard:
    """Conversations (or pieces of long ones) with the vertical index of their turns."""

    def __init__(self):
        self.convs: list[int] = []
        self.lengths: list[int] = []
        self.paths: list[list[tuple[int, int, int]]] = []       # (h1, h2, chars) from each one's first position on
        self.starts: dict[tuple[int, int, int, bool], int] = {}  # node a piece starts at, is it new here -> bitset
        self.postings: dict[tuple[int, int, int], int] = {}      # (position, h1, h2) -> bitset
        self.ending: dict[int, int] = {}                         # length -> bitset
        self.turns = 0

    def open(self, conv: int, length: int, at: tuple[int, int, int], new: bool) -> None:
        """A conversation, from node ``at`` = (depth, k1, k2) on; ``new`` when it begins here."""
        bit = 1 << len(self.convs)
        self.convs.append(conv)
        self.lengths.append(length)
        self.paths.append([])
        self.starts[*at, new] = self.starts.get((*at, new), 0) | bit
        self.ending[length] = self.ending.get(length, 0) | bit

    def turn(self, position: int, h1: int, h2: int, chars: int) -> None:
        key = (position, h1, h2)
        self.postings[key] = self.postings.get(key, 0) | 1 << len(self.convs) - 1
        self.paths[-1].append((h1, h2, chars))
        self.turns += 1

    def members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.convs[low.bit_length() - 1])
            bits ^= low
        return out

    def nodes(self) -> Iterator[tuple]:
        """Depth first over all nodes: depth, key, parent's key, smallest member, members, chars, ends."""
        for (start, k1, k2, new), bits in self.starts.items():
            if new:
                yield self._node(start, k1, k2, ROOT_KEY, ROOT_KEY, 0, bits)
            stack = [(start, k1, k2, bits & ~self.ending.get(start, 0))]
            while stack:
                depth, k1, k2, left = stack.pop()
                while left:
                    first = (left & -left).bit_length() - 1
                    path = self.paths[first]
                    if depth - start >= len(path):      # cut here: the next shard goes on
                        left &= left - 1
                        continue
                    h1, h2, chars = path[depth - start]
                    child = left & self.postings[depth + 1, h1, h2]
                    left ^= child
                    c1, c2 = k1 ^ h1, k2 ^ h2
                    yield self._node(depth + 1, c1, c2, k1, k2, chars, child)
                    if below := child & ~self.ending.get(depth + 1, 0):
                        stack.append((depth + 1, c1, c2, below))

    def _node(self, depth: int, k1: int, k2: int, p1: int, p2: int, chars: int, bits: int) -> tuple:
        smallest = self.convs[(bits & -bits).bit_length() - 1]      # rows come in the order of ids
        return depth, k1, k2, p1, p2, smallest, bits.bit_count(), chars, self.members(bits & self.ending.get(depth, 0))


def shard_nodes(batches: Iterator[pa.RecordBatch], conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS) -> Iterator[pa.RecordBatch]:
    """Nodes of every shard from rows sorted by conversation and position."""
    shard, now = Shard(), None

    def full(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PARTIAL.types)], schema=_PARTIAL)

    def closed() -> Iterator[pa.RecordBatch]:
        rows = []
        for node in shard.nodes():
            rows.append(node)
            if len(rows) == 10_000:
                yield full(rows)
                rows = []
        if rows:
            yield full(rows)

    for batch in batches:
        for conv, length, position, chars, h1, h2, k1, k2 in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
            if conv != now:
                if len(shard.convs) >= conversations or shard.turns >= turns:
                    yield from closed()
                    shard = Shard()
                now = conv
                shard.open(conv, length, (0, ROOT_KEY, ROOT_KEY), True)
                continue                                     # the row of position 0
            if shard.turns >= turns:
                yield from closed()
                shard = Shard()
                shard.open(conv, length, (position - 1, k1 ^ h1, k2 ^ h2), False)
            shard.turn(position, h1, h2, chars)
    if shard.convs:
        yield from closed()


def end_digests(partials: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 for nodes where conversations end.

    Ids of a list are first sorted within blocks of 2^20 ids; one task then reads a node's
    blocks in order, as a stream, for a digest cannot be taken from parts.
    """
    ids = partials.filter(F.size("ends") > 0).select(*NODE, F.explode("ends").alias("c"))
    block = F.shiftright("c", END_BITS)
    blocks = ids.groupBy(*NODE, block.alias("block")).agg(F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 3 + [pa.string()])], [*NODE, "ends_sha256"])

        for batch in batches:
            for depth, k1, k2, part in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if (depth, k1, k2) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, k1, k2), hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            if out:
                yield flushed()
                out = []
        if node is not None:
            out.append((*node, state.hexdigest()))
            yield flushed()

    return blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids").mapInArrow(
        digest, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Repeated rows are turns like any other. An empty
    table, or one without conversation ids, has no node. Extra columns are not read.
    """
    importable(conversations.sparkSession)
    own = staged(ordered_turns(conversations.select("conv_id", "turn", "role", "text")), "turns")
    paths = staged(rebuilt_turns(own), "paths")
    release(own)
    # a fresh hash keeps a conversation's rows in one task whatever files they were written to
    rows = paths.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    partials = staged(rows.mapInArrow(shard_nodes, _PARTIAL_DDL), "nodes")
    nodes = staged(partials.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum(F.size("ends")).alias("n_ends"),
        F.max("chars").alias("chars"), F.max("p1").alias("p1"), F.max("p2").alias("p2")), "merged")

    own = (F.col("n_convs") - 1) * F.col("chars")
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long")
    below = W.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    # of its other members a node needs the whole chains, of its representative the rest of one
    chains = nodes.groupBy("conv_id").agg(F.sum(own).alias("chain_saved"), F.max(leaf).alias("chain_leaf"), F.min("depth").alias("top"))
    ranked = nodes.withColumn("rest", F.sum(own).over(below)).join(chains, "conv_id")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    facts = ranked.select(*NODE, "conv_id", "n_convs", (F.col("rest") - F.col("chain_saved")).alias("saved"), zero.alias("leaves"), zero.alias("children"),
                          "top", "p1", "p2")
    members = paths.select(F.col("position").alias("depth"), "k1", "k2", "conv_id").join(chains, "conv_id").select(
        *NODE, none.alias("conv_id"), none.alias("n_convs"), F.col("chain_saved").alias("saved"), F.col("chain_leaf").alias("leaves"),
        zero.alias("children"), none.alias("top"), none.alias("p1"), none.alias("p2"))
    children = nodes.filter("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), none.alias("conv_id"), none.alias("n_convs"),
        zero.alias("saved"), zero.alias("leaves"), F.lit(1).cast("long").alias("children"), none.alias("top"), none.alias("p1"), none.alias("p2"))
    known = staged(facts.unionByName(members).unionByName(children).groupBy(*NODE).agg(
        F.max("conv_id").alias("conv_id"), F.max("n_convs").alias("n_convs"), F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"),
        F.sum("children").alias("n_children"), F.max("top").alias("top"), F.max("p1").alias("p1"), F.max("p2").alias("p2")), "trie")

    # within a chain the parent is the chain's own; only tops below the first turn look theirs up
    root = known.filter("depth = 0").select((F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("root_conv"))     # one row
    parents = known.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    at_top = (F.col("depth") == F.col("top")) & (F.col("depth") > 1)
    tops = known.filter(at_top).join(parents, ["depth", "p1", "p2"])
    rest = known.filter(~at_top).join(F.broadcast(root), "depth", "left").withColumn(
        "parent", F.when(F.col("depth") == 0, none).when(F.col("depth") == 1, F.col("root_conv")).otherwise(F.col("conv_id")))
    kept = [*NODE, "conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return tops.select(*kept).unionByName(rest.select(*kept)).join(end_digests(partials), NODE, "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


# The same trie in DuckDB's SQL. A CRC-32 is folded over a byte, then eight times -1 (a shift).
TRIE_SQL = """
    WITH RECURSIVE own AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
      SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
          list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                      lambda x: list_concat([ascii(x)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
          lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 6 AS head
      FROM (SELECT DISTINCT conv_id FROM own)),
    turns AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth, role, body FROM (
        SELECT i.conv_id, 0 AS part, o.p, o.role, o.body FROM ids i JOIN own o ON o.conv_id = i.base AND o.p <= i.head
        UNION ALL
        SELECT i.conv_id, 1, o.p, o.role, o.body FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.p > i.head)),
    paths AS (
      SELECT conv_id, depth, length(body) AS chars,
             md5(string_agg(sha256(length(role) || ':' || role || body), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
      FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
    linked AS (SELECT *, lag(node) OVER w AS above, lead(node) OVER w AS below FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
    nodes AS (
      SELECT depth, node, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars, count(DISTINCT below) AS n_children,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (below IS NULL), '')) AS ends_sha256
      FROM linked GROUP BY depth, node),
    sums AS (
      SELECT a.depth, a.node, sum((n.n_convs - 1) * n.chars) AS saved, count(*) FILTER (n.n_children = 0) AS leaves
      FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.depth, a.node)
    SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.leaves AS n_leaves,
           s.saved::BIGINT AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s USING (depth, node) LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.node = n.above"""
