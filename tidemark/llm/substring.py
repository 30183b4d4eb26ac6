"""Substring dedup: passages that occur earlier in the corpus are cut out.

Words are what stands between the characters U+0020 and U+0009 to U+000D, unchanged. A
window is WINDOW words in a row of one document. Every word covered by a window whose
words also start earlier (in a smaller id, or in the same document further left) goes;
windows are judged on the input, not on what is left.

The judges are suffix automata of reference shards: passages are streamed through the
automaton of a shard, whose matching statistics tell for each position the longest suffix
that occurs in the shard, and where it occurs first. To send every shard's automaton to
all documents would be work in proportion to the square of the corpus, so it is sent only
to the tasks that stream passages which the shard may hold:

1. Documents are gathered in blocks. Each block gives the hashes of its distinct windows,
   dealt by their leading bits, and learns which of them another block has earlier, and
   in which shard of words. A window that is everywhere is one hash per block.
2. From the answers each block cuts its reference passages (windows that come first and
   come again) and its candidate passages (windows that came before), by shard.
3. Each shard builds the automaton of its reference passages and streams its candidates.
   The candidates of a sought-after shard are spread over tasks that each build it.

A window goes when the automaton has it earlier. One that only shared the hash of an
earlier window is refused, and its document is cut again without it.

Defined cases: a null or blank text has no words. A text of fewer than WINDOW words loses
nothing. Rows with a null id come after all others. Of rows with the same id, one row's
windows count as earlier than another's in a fixed order. Repeated rows give repeated
results; other columns are ignored. A document longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .automaton import Automaton
from .common import free_name, id_text, quoted, release, sha256_hex, spread, texts
from .common import staged_in_small_batches as staged
from .shingles import runs, word_hashes

WINDOW = 20
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 4096
SHARD_WORDS = 50_000            # reference shards are cut at these many words of a block
# A window's home is one number: partition, block in it, shard in that. A block has at most the
# 2^15 shards of a text of 2 GB, a partition at most 2^20 blocks (4 TB), so 2^28 partitions fit.
SHARDS_PER_BLOCK, BLOCKS_PER_PARTITION = 1 << 15, 1 << 20
HASHES_PER_TASK = 1 << 21
HASHES_AT_ONCE = 1 << 18        # of a task's, sorted at a time
STREAM_WORDS = 200_000          # candidates of one shard that go to one task
LAST = np.iinfo(np.int64).max   # stands for a null id
BREAKS = np.zeros(256, bool)
BREAKS[[9, 10, 11, 12, 13, 32]] = True


def _pack(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x)


def _unpack(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def _pack_texts(rows: list[bytes]) -> bytes:
    return _pack(np.array([len(rows), *map(len, rows)], np.int64).tobytes() + b"".join(rows))


def _unpack_texts(packed: bytes) -> list[bytes]:
    raw = _unpack(packed)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(raw, np.int64, n, 8))
    return [raw[a:b] for a, b in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist())]


def make_blocks(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) gathered: block, ids, texts, n_words. In a block, ids ascend."""
    def gather(batches):
        from pyspark import TaskContext

        base, number = TaskContext.get().partitionId() * BLOCKS_PER_PARTITION, 0
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, number
            held.sort(key=lambda r: r[0])
            rows, held, size, number = held, [], 0, number + 1
            if number >= BLOCKS_PER_PARTITION or base >= np.iinfo(np.int64).max // SHARDS_PER_BLOCK - number:
                raise OverflowError("more blocks than can be numbered: read the documents in smaller partitions")
            return pa.RecordBatch.from_arrays([
                pa.array([base + number], pa.int64()), pa.array([np.array([r[0] for r in rows], np.int64).tobytes()], pa.binary()),
                pa.array([_pack_texts([r[1] for r in rows])], pa.binary()),
                pa.array([sum(len(r[1].split()) for r in rows)], pa.int64())], ["block", "ids", "texts", "n_words"])

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                data = text.encode("utf-8", "replace")
                if held and (size + len(data) > BLOCK_BYTES or len(held) >= BLOCK_ROWS):
                    yield flush()
                held.append((LAST if i is None else i, data))
                size += len(data)
        if held:
            yield flush()

    return spread(docs).mapInArrow(gather, "block long, ids binary, texts binary, n_words long")


class Windows:
    """The windows of a block: hash, row and start of each; ``entry`` numbers the distinct ones."""

    def __init__(self, rows: list[bytes], bits: int, window: int):
        words = [word_hashes(t, BREAKS)[0] for t in rows]
        self.n_words = np.array([len(w) for w in words], np.int64)
        hashes = [runs(w, window) for w in words]
        count = np.array([len(h) for h in hashes], np.int64)
        self.hash = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        self.row = np.repeat(np.arange(len(rows)), count)
        self.begin = np.concatenate([[0], np.cumsum(count)])        # first window of each row
        self.start = np.arange(len(self.hash)) - self.begin[self.row]
        before = np.cumsum(self.n_words) - self.n_words
        self.shard = (before[self.row] + self.start) // SHARD_WORDS
        _, first, inverse = np.unique(self.hash, return_index=True, return_inverse=True)
        part = (self.hash[first] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(first), np.int64)
        order = np.lexsort((first, part))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.first, self.part, self.entry = first[order], part[order], rank[inverse]
        self.comes_first = np.zeros(len(self.hash), bool)
        self.comes_first[self.first] = True


def ask(blocks: DataFrame, bits: int, window: int) -> DataFrame:
    """A row per block and part: the hashes of its distinct windows, with the id and shard of each."""
    def run(batches):
        for batch in batches:
            for block, ids, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "texts"))):
                w = Windows(_unpack_texts(packed), bits, window)
                ids = np.frombuffer(ids, np.int64)
                parts, begin = np.unique(w.part, return_index=True)
                out = []
                for a, b in zip(begin, [*begin[1:], len(w.part)]):
                    f = w.first[a:b]
                    seven = (w.hash[f] << np.uint64(bits) >> np.uint64(8)).view(np.uint8).reshape(-1, 8)[:, :7]
                    own = ids[w.row[f]]
                    out.append((seven.tobytes(), _pack(np.diff(own, prepend=0).tobytes() + np.diff(w.shard[f], prepend=0).tobytes())))
                yield pa.RecordBatch.from_arrays([
                    pa.array(parts, pa.int64()), pa.array([block] * len(out), pa.int64()),
                    pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())],
                    ["part", "block", "hashes", "places"])

    return blocks.mapInArrow(run, "part long, block long, hashes binary, places binary")


def answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each block of a part: which hashes another has earlier and where, which others have later."""
    sizes = [len(h) // 7 for h in pdf["hashes"]]
    ends = np.cumsum(sizes)
    hashes, ids, shards = np.zeros(sum(sizes), np.uint64), np.empty(sum(sizes), np.int64), np.empty(sum(sizes), np.int32)
    bytes_of = hashes.view(np.uint8).reshape(-1, 8)
    for e, n, seven, packed in zip(ends, sizes, pdf["hashes"], pdf["places"]):
        bytes_of[e - n:e, :7] = np.frombuffer(seven, np.uint8).reshape(-1, 7)
        ids[e - n:e], shards[e - n:e] = np.frombuffer(_unpack(packed), np.int64).reshape(2, -1).cumsum(1)
    number = pdf["block"].to_numpy(np.int64)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    home = np.full(len(hashes), -1, np.int64)       # where an earlier window is; -2: others come later
    # equal hashes have equal leading bytes, so a range of these is judged by itself, in little memory
    step = max(1, 256 * HASHES_AT_ONCE // max(1, len(hashes)))
    for low in range(0, 256, step):
        at = np.flatnonzero((bytes_of[:, 6] >= low) & (bytes_of[:, 6] <= min(255, low + step - 1)))
        if not len(at):
            continue
        order = at[np.lexsort((number[row[at]], ids[at], hashes[at]))]
        h = hashes[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        group = np.cumsum(new) - 1
        leader = order[np.flatnonzero(new)][group]
        many = np.bincount(group)[group] > 1
        home[order] = np.where(new, np.where(many, -2, -1), number[row[leader]] * SHARDS_PER_BLOCK + shards[leader])
    return pd.DataFrame({"block": pdf["block"], "part": pdf["part"],
                         "home": [_pack(home[e - n:e].tobytes()) for e, n in zip(ends, sizes)]})


def cut(words: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """Which words are covered by windows at ``starts``."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return change.cumsum()[:-1] > 0


def rest_of(data: bytes, gone: np.ndarray) -> str:
    """The text without the words that are gone; each kept word keeps the blank after it."""
    if not gone.any():
        return data.decode("utf-8", "replace")
    b = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~BREAKS[b], [False]])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = [*starts[1:].tolist(), len(data)]
    return b"".join(data[a:e] for a, e, g in zip(starts.tolist(), ends, gone) if not g).decode("utf-8", "replace").strip()


def result_row(row: int, doc_id: int, data: bytes, starts: np.ndarray, window: int, with_text: bool) -> dict:
    words = data.split()
    gone = cut(words, starts, window)
    return {"kind": 2, "row": row, "doc_id": doc_id, "n_words": len(words), "n_removed": int(gone.sum()),
            "sha": sha256_hex(b" ".join(w for w, g in zip(words, gone) if not g)), "own_sha": sha256_hex(data), "starts": _pack(starts.astype(np.int64).tobytes()),
            "body": rest_of(data, gone) if with_text and gone.any() else None}


SPANS = ("block long, kind int, home long, row long, doc_id long, start long, n_words long, n_removed long, "
         "sha string, own_sha string, starts binary, body string")
COLUMNS = [c.split()[0] for c in SPANS.split(", ")]


def passages(block: int, ids: np.ndarray, rows: list[bytes], homes: dict[int, bytes], bits: int, window: int,
             with_text: bool) -> Iterator[dict]:
    """References (kind 0), candidates (1) and results as if no candidate is refused (2)."""
    w = Windows(rows, bits, window)
    home = np.concatenate([np.frombuffer(_unpack(homes[p]), np.int64) for p in np.unique(w.part).tolist()] or [np.zeros(0, np.int64)])
    again = np.bincount(w.entry[~w.comes_first], minlength=len(home)) > 0
    own = block * SHARDS_PER_BLOCK + w.shard
    refers = w.comes_first & ((home == -2) | (again & (home < 0)))[w.entry]
    first_home = np.where(home >= 0, home, own[w.first] if len(home) else home)
    seeks = ~w.comes_first | (home >= 0)[w.entry]
    for kind, chosen, to in ((0, refers, own), (1, seeks, first_home[w.entry] if len(home) else own)):
        k = np.flatnonzero(chosen)
        if not len(k):
            continue
        split = np.flatnonzero((np.diff(k) != 1) | (np.diff(w.row[k]) != 0) | (np.diff(to[k]) != 0)) + 1
        for part in np.split(k, split):
            a, b = part[0], part[-1]
            r, s = int(w.row[a]), int(w.start[a])
            yield {"kind": kind, "home": int(to[a]), "row": r, "doc_id": int(ids[r]), "start": s,
                   "n_words": int(w.start[b]) - s + window, "words": (r, s, int(w.start[b]) + window)}
    for r, data in enumerate(rows):
        a, b = w.begin[r], w.begin[r + 1]
        yield result_row(r, int(ids[r]), data, np.flatnonzero(seeks[a:b]), window, with_text)


def judge(pdf: pd.DataFrame, window: int) -> list[tuple[int, int, int]]:
    """Candidate windows (block, row, start) of a shard that do not occur earlier in it."""
    pdf = pdf.sort_values(["doc_id", "block", "row", "start"])
    refs, seekers = pdf[pdf["kind"] == 0], pdf[pdf["kind"] == 1]
    number: dict[str, int] = {}
    auto, places = Automaton(), []
    for r in refs.itertuples():
        words = [number.setdefault(x, len(number)) for x in r.body.split(" ")]
        auto.add(words)
        places += [(r.doc_id, r.block, r.row, r.start + i) for i in range(len(words))]
    nexts, link, length, first = auto.next, auto.link, auto.length, auto.first
    refused = []
    for r in seekers.itertuples():
        state = size = 0
        for i, x in enumerate(r.body.split(" ")):
            symbol = number.get(x, -1)
            while state and symbol not in nexts[state]:
                state = link[state]
                size = length[state]
            to = nexts[state].get(symbol)
            if to is not None:
                state = to
                size += 1
            if size >= window:
                # shorten the match to a window, whose state knows where it ends first
                size = window
                while length[link[state]] >= window:
                    state = link[state]
            start = i + 1 - window
            if start >= 0:
                earlier = False
                if size >= window:
                    doc_id, block, row, at = places[first[state]]
                    earlier = (doc_id, block, row, at + 1 - window) < (r.doc_id, r.block, r.row, r.start + start)
                if not earlier:
                    refused.append((r.block, r.row, r.start + start))
    return refused


def cut_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and with ``with_text`` also text and own_sha256.

    Ids are integers. ``kept_sha256`` is of the kept words joined by single spaces. ``text``
    is what stays of a document that lost words (null for others), with the blanks between
    kept words; ``own_sha256`` is of the whole text.
    """
    source = id_text(docs, id_col, text_col)
    spark = docs.sparkSession
    blocks = staged(make_blocks(source.withColumn("doc_id", F.col("doc_id").cast("long"))), "blocks")
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, total / HASHES_PER_TASK)))))
    homes = staged(ask(blocks, bits, window).groupBy("part").applyInPandas(answer, "block long, part long, home binary"), "homes")

    def split(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in left.itertuples():
            rows = _unpack_texts(r.texts)
            split_rows: dict[int, list[bytes]] = {}
            for p in passages(r.block, np.frombuffer(r.ids, np.int64), rows, dict(zip(right["part"], right["home"])), bits,
                              window, with_text):
                if "words" in p:
                    i, a, b = p.pop("words")
                    if i not in split_rows:
                        split_rows = {i: rows[i].split()}
                    p["body"] = b" ".join(split_rows[i][a:b]).decode("utf-8", "replace")
                out.append(p | {"block": r.block})
        return pd.DataFrame(out, columns=COLUMNS)

    found = staged(blocks.groupBy("block").cogroup(homes.groupBy("block")).applyInPandas(split, SPANS), "passages")
    release(homes)
    spans = found.filter("kind < 2").select("block", "kind", "home", "row", "doc_id", "start", "n_words", "body")
    wanted = spans.filter("kind = 1").groupBy("home").agg(F.ceil(F.sum("n_words") / STREAM_WORDS).cast("int").alias("tasks"))
    placed = spans.join(wanted, "home").withColumn("task", F.explode(F.when(
        F.col("kind") == 0, F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("block", "row", "start"), F.col("tasks")).cast("int")))))

    def stream(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(judge(pdf, window), columns=["block", "row", "start"])

    # dealt by both columns: the join above has the rows by home alone, which would undo the spreading
    refused = staged(placed.repartition("home", "task").groupBy("home", "task").applyInPandas(stream, "block long, row long, start long"), "refused")
    results = found.filter("kind = 2").select("block", "row", "doc_id", "n_words", "n_removed", "sha", "own_sha", "starts", "body")
    if not refused.isEmpty():
        results = _cut_again(results, blocks, refused, window, with_text)
    else:
        release(blocks)
    out = results.select(F.when(F.col("doc_id") != int(LAST), F.col("doc_id")).cast(source.schema["doc_id"].dataType).alias("doc_id"),
                         "n_words", "n_removed", F.col("sha").alias("kept_sha256"), F.col("body").alias("text"),
                         F.col("own_sha").alias("own_sha256"))
    return out if with_text else out.drop("text", "own_sha256")


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    length_col: str = "n_chars") -> DataFrame:
    """``docs``, all columns, with what stays of each text (and its length, where there is such a column).

    A document whose words all go is left out. Rows that agree in id and text take the
    results of these in any order.
    """
    own_id, sha, nth, body, empty, id_2, sha_2, nth_2 = names = [
        free_name(docs.columns, c) for c in ("__id", "__sha", "__nth", "__text", "__empty", "__id_2", "__sha_2", "__nth_2")]
    c_id, c_sha, c_nth, c_body, c_empty, c_id_2, c_sha_2, c_nth_2 = (F.col(quoted(c)) for c in names)
    same = Window.partitionBy(c_id, c_sha)
    changed = cut_repeats(docs, window, id_col, text_col).filter("n_removed > 0").select(
        F.col("doc_id").alias(own_id), F.col("own_sha256").alias(sha), F.col("text").alias(body),
        (F.col("n_removed") == F.col("n_words")).alias(empty)).withColumn(nth, F.row_number().over(same.orderBy(c_empty)))
    text = F.col(quoted(text_col))
    keyed = docs.withColumn(own_id, F.col(quoted(id_col))).withColumn(sha, F.sha2(F.coalesce(text, F.lit("")), 256))
    repeated = not keyed.groupBy(c_id).agg(F.count("*").alias("m")).filter("m > 1").isEmpty()
    keyed = keyed.withColumn(nth, F.row_number().over(same.orderBy(c_id)) if repeated else F.lit(1))
    changed = changed.toDF(id_2, sha_2, body, empty, nth_2)
    both = keyed.join(changed, c_id.eqNullSafe(c_id_2) & (c_sha == c_sha_2) & (c_nth == c_nth_2), "left").filter(c_empty.isNull() | ~c_empty)
    out = both.withColumn(text_col, F.coalesce(c_body, text))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(c_body.isNotNull(), F.length(c_body)).otherwise(
            F.col(quoted(length_col))).cast(docs.schema[length_col].dataType))
    return out.select([F.col(quoted(c)) for c in docs.columns])


def _cut_again(results: DataFrame, blocks: DataFrame, refused: DataFrame, window: int, with_text: bool) -> DataFrame:
    """The results with the documents of refused windows cut without these."""
    docs = refused.select("block", "row").distinct()
    names = ["block", "row", "doc_id", "n_words", "n_removed", "sha", "own_sha", "starts", "body"]

    def run(key, block: pd.DataFrame, told: pd.DataFrame, no: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in block.itertuples():
            rows = _unpack_texts(b.texts)
            for r in told.itertuples():
                starts = np.setdiff1d(np.frombuffer(_unpack(r.starts), np.int64), no["start"][no["row"] == r.row].to_numpy(np.int64))
                out.append(result_row(r.row, r.doc_id, rows[r.row], starts, window, with_text) | {"block": b.block})
        return pd.DataFrame(out, columns=names)

    both = results.join(docs, ["block", "row"]).select("block", "row", "doc_id", "starts", F.lit(None).cast("long").alias("start")).unionByName(
        refused.select("block", "row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("starts"), "start"))

    def split(key, block: pd.DataFrame, both: pd.DataFrame) -> pd.DataFrame:
        if not len(both):
            return pd.DataFrame([], columns=names)
        return run(key, block, both[both["doc_id"].notna()].astype({"doc_id": "int64"}), both[both["start"].notna()])

    again = blocks.join(docs.select("block").distinct(), "block", "left_semi").groupBy("block").cogroup(
        both.groupBy("block")).applyInPandas(split, results.schema)
    return results.join(docs, ["block", "row"], "left_anti").unionByName(again)
