"""Exact deduplication through a persistent digest index.

The index is a Parquet table bucketed and sorted by digest, which lies in a folder: whoever opens the folder, in any session and under any
table name, finds what is stored. A batch of rows is first reduced to one row per digest (map-side combined, so a digest shared by a
third of all rows is one row per task before the shuffle); these go through a sort-merge anti-join with the index, whose side
is not shuffled, and what is new is appended. A bucket has a sorted file of each batch, which the task that reads it sorts into one. The rows
then read their group from the index.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import pick_rows, row_key, scratch_path, stored, table

#: White space that does not count when texts are compared (fixed value).
BLANKS = r"[\x20\x09-\x0D]"


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the UTF-8 text without blanks; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "").cast("binary"), 256)


def row_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, row_id, n_points, text_sha256) of every row. k1 and k2 name a row by its content; row_id tells rows
    apart that repeat it, and holds for one reading, so the keys are stored before use."""
    return docs.select("doc_id", *row_key(), F.monotonically_increasing_id().alias("row_id"),
                       F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
                       text_digest(F.col("text")).alias("text_sha256"))


#: Digests of a bucket that a new index reckons with, and its least and greatest number of buckets.
BUCKET_ROWS, BUCKETS = 2_000_000, (16, 50_000)


class DigestIndex:
    """A digest index kept as a bucketed table; ``path`` is a folder that all executors share, ``name`` the table's name in this session's
    catalog. The stored index tells its number of buckets; a new one gets ``buckets``, or one for each ``BUCKET_ROWS`` of
    the ``expected`` rows (default: those of its first batch).

    ``add`` may be called with batch after batch: the row that stays of a group is the best row (most code points,
    then smallest doc_id, nulls last, then row order) of the first batch that held its digest. Row ids hold for one batch
    alone, so the index keeps the batch of each."""

    def __init__(self, spark: SparkSession, path: str | None = None, name: str | None = None, buckets: int | None = None,
                 expected: int | None = None):
        self.spark, self.buckets, self.expected = spark, buckets, expected
        self.path = (path or scratch_path(spark, "digests")).rstrip("/")
        self.name = name or f"digest_index_{uuid.uuid4().hex[:12]}"

    def _stored(self):
        """(number of buckets, schema) of the index at the path, or None. They lie in a folder whose name readers of the table pass over."""
        try:
            note = self.spark.read.parquet(f"{self.path}/_index")
        except AnalysisException as e:
            if (e.getCondition() or "") != "PATH_NOT_FOUND":
                raise
            return None
        row = note.first()
        return row.buckets, T.StructType.fromDDL(row.columns)

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self) -> DataFrame:
        """The stored digests as a bucketed table, registered in this session's catalog over the files if it is not yet."""
        buckets, schema = self._stored()
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (text_sha256) SORTED BY (text_sha256) "
                           f"INTO {buckets} BUCKETS LOCATION '{self.path}'")
        else:
            self.spark.catalog.refreshTable(self.name)  # files that others have added
        return self.spark.table(self.name)

    def create(self, schema: T.StructType, rows: int) -> None:
        """Note a new index at the path, which must hold none."""
        least, most = BUCKETS
        buckets = self.buckets or min(max(-(-(self.expected or rows) // BUCKET_ROWS), least), most)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.createDataFrame([(buckets, columns)], "buckets int, columns string").coalesce(1).write.parquet(f"{self.path}/_index")

    def _append(self, groups: DataFrame) -> None:
        self.read()  # the table is there before files are added: a new table would replace them
        buckets, schema = self._stored()
        (groups.select(*schema.names).write.format("parquet").mode("append")
         .bucketBy(buckets, "text_sha256").sortBy("text_sha256").saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)

    def add(self, keys: DataFrame, batch: str) -> None:
        """Append the digests of ``keys`` (see ``row_keys``) that the index doesn't hold yet. No other call may have the same
        ``batch``."""
        best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"),
                              F.col("doc_id").alias("keep_id"), F.col("row_id").alias("keep_row")))
        groups = (keys.groupBy("text_sha256").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size"))
                  .select("text_sha256", "b.keep_id", "b.keep_row", "group_size", F.lit(batch).alias("batch")))
        if not self.exists():
            self.create(groups.schema, keys.count())
        else:
            groups = groups.join(self.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
        self._append(groups)

    def lookup(self, keys: DataFrame, batch: str) -> DataFrame:
        """Every row of ``keys`` with keep_id, group_size (rows of the batch that brought the digest) and kept: whether it is
        the row that stays, which no row of a later batch is.

        The index is read as plain files here: with a shuffle on both sides a digest of very many rows is split
        by the adaptive skew join, which a bucketed side would not allow."""
        index = self.spark.read.schema(self.read().schema).parquet(self.path)
        kept = (F.col("batch") == batch) & (F.col("row_id") == F.col("keep_row"))
        return keys.join(index, "text_sha256").select(
            "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "k1", "k2")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, keep_id, group_size, kept,
    text_sha256, k1, k2. Texts are equal when identical without blanks; null and blank-only texts equal the empty
    text. Of rows that repeat a doc_id and text exactly one is kept. An empty table gives an empty table."""
    index, batch = index or DigestIndex(docs.sparkSession), uuid.uuid4().hex
    keys = stored(row_keys(docs), "keys")
    index.add(keys, batch)
    return index.lookup(keys, batch)


def without_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay."""
    return pick_rows(docs, stored(exact_dedup(docs, index).where("kept").select("k1", "k2"), "kept"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (
  SELECT h, count(*) AS group_size FROM d GROUP BY h),
k AS (
  SELECT h, doc_id AS keep_id FROM d QUALIFY row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) = 1)
SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, d.h AS text_sha256
FROM d JOIN g ON d.h = g.h JOIN k ON d.h = k.h
"""
