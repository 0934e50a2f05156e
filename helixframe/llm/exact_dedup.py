"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

A batch of documents is reduced to (id, code points, SHA-256 of the text
without white space). Its groups are anti-joined to the index, of which no
bucket is shuffled, and the new digests are appended under the batch's name. A batch that is
added again under its name, as after a crash before or after its digests were
appended, finds it and gets the same verdicts; without a name each addition is a batch of its own, so rows
that are delivered again are copies. One batch is added at a time.

Defined results: a null text counts as empty; among equal texts the row with the
most code points, then the smallest id (null ids last), then the smallest hash of the row
stays; repeated rows count as copies, one of them stays; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import SPACES, join_by_key, keep_rows, row_key, written

INDEX_SCHEMA = "digest binary, keep_id long, batch string"


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text without white space."""
    bare = F.translate(F.coalesce(text, F.lit("")), SPACES, "")
    return F.unhex(F.sha2(bare, 256))


class DigestIndex:
    """The digests seen so far, as a bucketed and sorted table of the session's catalog."""

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        """name: a table of the catalog, made if it is new. buckets: for a new table; a power of two that grows with the corpus."""
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not spark.catalog.tableExists(self.name):
            self._append(spark.createDataFrame([], INDEX_SCHEMA))

    def _append(self, rows: DataFrame) -> None:
        # a file a bucket: joins need no shuffle of the index
        rows = rows.repartition(self.buckets, "digest")
        rows.write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self) -> None:
        """One sorted file a bucket again, after many batches: a new table takes the old one's name."""
        new, old = f"{self.name}_{uuid.uuid4().hex}", f"{self.name}_{uuid.uuid4().hex}"
        self.table().repartition(self.buckets, "digest").write.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(new)
        self.spark.sql(f"ALTER TABLE {self.name} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {new} RENAME TO {self.name}")
        self.spark.sql(f"DROP TABLE {old}")

    def judged(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_name: str | None = None) -> DataFrame:
        """As add(), with the row's key (common.row_key)."""
        text = F.col(text_col)
        batch = written(
            docs.select(
                F.col(id_col).cast("long").alias("doc_id"),
                F.coalesce(F.length(text), F.lit(0)).alias("n_chars"),
                digest(text).alias("digest"),
                *row_key(docs),
                F.monotonically_increasing_id().alias("row_id"),
            ),
            "digests",
        )
        n, tag = batch.count(), batch_name or uuid.uuid4().hex
        first = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), "doc_id", "__k1", "__k2", "row_id")
        groups = written(batch.groupBy("digest").agg(F.min(first).alias("best"), F.count("*").alias("group_size")), "digest-groups")
        # a batch that was cut off finds those of its digests that are there already, and appends the others
        new = groups.join(self.table().hint("merge"), "digest", "left_anti")
        self._append(new.select("digest", F.col("best.doc_id").alias("keep_id"), F.lit(tag).alias("batch")))
        own = groups.select("digest", "group_size", F.col("best.row_id").alias("best_row"))
        verdicts = own.join(self.table().hint("merge"), "digest")
        out = join_by_key(batch, verdicts, "digest", "group_size", n)
        kept = (F.col("batch") == tag) & (F.col("row_id") == F.col("best_row"))
        return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest", "__k1", "__k2")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_name: str | None = None) -> DataFrame:
        """Deduplicate docs against the index and each other, and append what is new.

        batch_name: what is added again under the same name, as after a crash, gets the same verdicts. Without one, or under
        another, rows that were added before are copies, however they are delivered.

        Returns a row for each row of docs: doc_id, keep_id, group_size (rows of
        docs with the text), kept, digest. What the index had before stays kept there.
        """
        return self.judged(docs, id_col, text_col, batch_name).drop("__k1", "__k2")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = DigestIndex(spark)
    out = written(index.add(docs), "verdicts")
    index.drop()
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay, judged row by row: rows that share an id but not their text are different documents; of equal rows one stays."""
    index = DigestIndex(spark)
    verdicts = written(index.judged(docs).filter("group_size > 1").select("__k1", "__k2", "kept"), "copies")
    index.drop()
    return keep_rows(docs, verdicts)


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS k,
         first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, h AS text_sha256 FROM r
"""
