"""Exact dedup against a persistent index of digests, in DataFrame operations only.

Texts are equal when they agree after every space, tab, line feed, vertical tab, form
feed and carriage return is deleted (the characters U+0009 to U+000D and U+0020).

The index is a table of one row per distinct text, bucketed and sorted by digest. A new
batch is cut to one row per digest before anything is shuffled whole, loses the digests
that the index has by a sort-merge anti-join, and what is left is appended.

Defined cases: a null text counts as empty, and all empty texts are equal. A null id may
stay when it is the only one or has the longest text; otherwise it comes after all other
ids. Of rows that agree in id and text one stays. An empty input gives no rows. Other
columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import free_name, id_text, quoted, staged

BLANKS = " \t\n\x0b\x0c\r"
HOT_GROUPS = 4096       # no more groups than this can each hold over 1/4096 of the rows


LEAST_BUCKETS = 32
BUCKET_ROWS = 1 << 20   # of about 100 bytes each


def buckets_for(rows: int) -> int:
    """Buckets of an index of so many rows: a power of two, so that one bucket is one task of bounded size."""
    return max(LEAST_BUCKETS, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length())


def text_digest(text):
    """SHA-256 of the text without its blanks, as 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, "").cast("binary"), 256))


class DigestIndex:
    """Digests of every text seen so far, kept at ``path`` (a new folder where None).

    Without ``buckets`` a new index takes their number from the distinct texts of its first
    batch. An index that is opened again needs the number it was made with (``self.buckets``).
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.buckets, self.id_type = spark, buckets, id_type
        self.path = path or f"{scratch_dir(spark, 'digests')}/index"
        self.name = f"digests_{uuid.uuid4().hex[:12]}"
        if buckets:
            self._create()

    def _create(self) -> None:
        self.spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id {self.id_type}, batch STRING, keep_row BIGINT) "
                       f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}'")

    def _append(self, rows: DataFrame) -> None:
        (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
             .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)

    def folded(self, path: str | None = None) -> DigestIndex:
        """A new index with these rows, one file a bucket and as many buckets as its rows now need.

        Every batch adds a file to each bucket, so an index of many batches is sorted again at
        each join; after folding its buckets are read in order.
        """
        out = DigestIndex(self.spark, path, buckets_for(self.rows().count()), self.id_type)
        out._append(self.rows())
        return out

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; the files stay and can be opened again by their path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Enter a batch; one row per input row: doc_id, keep_id, group_size, kept, text_sha256.

        ``keep_id`` is the row that stands for the text: of an earlier batch if the index
        had the text, else the longest original text (code points), then the smallest id.
        ``group_size`` counts the rows of this batch with that text.
        """
        batch = uuid.uuid4().hex
        source = id_text(docs, id_col, text_col)
        seen = staged(source.select(
            "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("chars"), text_digest(F.col("text")).alias("digest"),
        ).withColumn("row", F.monotonically_increasing_id()), "exact-rows")
        best = F.min(F.struct((-F.col("chars")).alias("chars"), F.isnull("doc_id").alias("missing"), "doc_id", "row"))
        groups = staged(seen.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")), "exact-groups")
        if not self.buckets:
            self.buckets = buckets_for(groups.count())
            self._create()
        fresh = groups.hint("merge").join(self.rows(), "digest", "left_anti").select(
            "digest", F.col("best.doc_id").alias("keep_id"), F.lit(batch).alias("batch"),
            F.col("best.row").alias("keep_row"))
        self._append(fresh)
        known = staged(groups.select("digest", "group_size").hint("merge").join(self.rows(), "digest"), "exact-known")
        # A group with more than 1/4096 of the rows is looked up from a broadcast of at most 4096 rows;
        # the others meet by a sort-merge join in which no key can be hot.
        total = seen.count()
        hot = F.broadcast(known.filter(F.col("group_size") * HOT_GROUPS > total))
        cold = known.filter(F.col("group_size") * HOT_GROUPS <= total)
        found = seen.join(hot, "digest").unionByName(
            seen.join(hot.select("digest"), "digest", "left_anti").hint("merge").join(cold, "digest"))
        return found.select(
            "doc_id", "keep_id", "group_size",
            ((F.col("batch") == batch) & (F.col("row") == F.col("keep_row"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """:meth:`DigestIndex.add` on a new index where none is given."""
    spark = docs.sparkSession
    own = index or DigestIndex(spark, id_type=docs.schema[id_col].dataType.simpleString())
    out = own.add(docs, id_col, text_col)
    if index is None:
        own.close()
    return out


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`exact_dedup` keeps."""
    verdict = exact_dedup(docs, id_col, text_col, index)
    sha, own_id, own_sha = (free_name(docs.columns, c) for c in ("__sha_of", "__keep", "__sha"))
    stays = verdict.filter("kept").select(F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_sha))
    kept = docs.withColumn(sha, F.lower(F.hex(text_digest(F.col(quoted(text_col)))))).join(
        stays, F.col(quoted(id_col)).eqNullSafe(F.col(quoted(own_id))) & (F.col(quoted(sha)) == F.col(quoted(own_sha))), "left_semi")
    # rows that agree in id and text cannot be told apart by the join; only then a second shuffle is needed
    if not verdict.groupBy("doc_id", "text_sha256").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, sha])
    return kept.drop(sha)
