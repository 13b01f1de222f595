"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the digest. A batch is first reduced to one row per
digest, so the anti-join against the index is a sort-merge join of unique keys: the index side is
neither shuffled nor sorted again, and no hot text reaches it more than once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer.llm.common import blocks_for, new_path, text_of, winning_rows, written

#: Buckets of an index at least, and digests of a bucket, about (80 bytes each).
BUCKETS, PER_BUCKET = 16, 1 << 20


def digest(text: str = "text") -> Column:
    """SHA-256 of the UTF-8 text in lowercase hex; null counts as empty."""
    return F.sha2(text_of(text).cast("binary"), 256)


def buckets_for(digests: int) -> int:
    """The power of two of buckets that keeps each at about PER_BUCKET digests; BUCKETS at least."""
    return max(BUCKETS, 1 << (blocks_for(digests, PER_BUCKET) - 1).bit_length())


class DigestIndex:
    """Digests seen so far, the document that stands for each and the batch that brought it.

    The number of buckets is a property of the table: it is fixed when the table is made, which the first
    batch does, and an index opened again takes it from the catalog.
    """

    def __init__(self, spark: SparkSession, table: str, expected: int = 0, path: str | None = None):
        """Opens the table, or makes it with the first batch (below the shared folder unless path is given).

        expected: digests that the index is going to hold; the first batch's, if they are more.
        """
        self.spark, self.table, self.expected, self.path = spark, table, expected, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def buckets(self) -> int:
        """Buckets of the stored table."""
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where("col_name = 'Num Buckets'").first()
        return int(told.data_type)

    def _make(self, digests: int) -> None:
        empty = self.spark.createDataFrame([], "text_sha256 string, keep_id long, batch string")
        self._append(empty, buckets_for(max(digests, self.expected)), self.path or new_path(self.spark, self.table))

    def _append(self, rows: DataFrame, buckets: int, path: str | None = None) -> None:
        out = (rows.repartition(buckets, "text_sha256").write.format("parquet").mode("append")
               .bucketBy(buckets, "text_sha256").sortBy("text_sha256"))
        (out.option("path", path) if path else out).saveAsTable(self.table)

    def entries(self) -> DataFrame:
        return self.spark.read.table(self.table)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Appends the digests of groups (text_sha256, keep_id, one row each) that the index lacks."""
        if not self.exists():
            self._make(groups.count())
        fresh = groups.select("text_sha256", "keep_id").join(
            self.entries().hint("merge"), "text_sha256", "left_anti")
        self._append(written(fresh.withColumn("batch", F.lit(batch)), "digest-fresh"), self.buckets())

    def forget(self) -> None:
        """Takes the table's name out of the catalog; what was read from it keeps its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def label(self, docs: DataFrame) -> DataFrame:
        """Adds a batch and tells for every row of it which row stays.

        Returns doc_id, keep_id, group_size (equal texts in this batch), kept, text_sha256. Of equal
        texts the largest doc_id stays, unless an earlier batch brought that text: then keep_id is
        the earlier document and no row of this batch stays. Null doc_ids lose to all others; of
        rows equal in doc_id and text one stays. An empty table gives no rows and leaves the index.
        """
        batch = uuid.uuid4().hex
        rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("text_sha256")),
                       "digests")
        groups = written(rows.groupBy("text_sha256").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "digest-groups")
        self.add(groups, batch)
        known = groups.drop("keep_id").join(self.entries().hint("merge"), "text_sha256")
        ids = rows.groupBy("text_sha256", "doc_id").agg(F.count("*").alias("times"))
        each = ids.join(known, "text_sha256").select(
            "*", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth"))
        stays = ((F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1))
        return each.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")

    def keep_new(self, docs: DataFrame) -> DataFrame:
        """Adds a batch and returns its rows that stay, with all their columns."""
        stays = self.label(docs).where("kept").select("doc_id", "text_sha256")
        return winning_rows(docs, digest(), stays)


def label(docs: DataFrame) -> DataFrame:
    """DigestIndex.label for one batch alone: by an index of its own, which leaves no name in the catalog."""
    index = DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex}")
    out = index.label(docs)
    index.forget()
    return out


def keep_new(docs: DataFrame) -> DataFrame:
    """DigestIndex.keep_new for one batch alone."""
    stays = label(docs).where("kept").select("doc_id", "text_sha256")
    return winning_rows(docs, digest(), stays)
