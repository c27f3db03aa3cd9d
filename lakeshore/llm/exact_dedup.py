"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one row
per digest, anti-joined with the index by sort-merge (the index side is neither
shuffled nor re-bucketed), and the digests that are new are appended. Built-in
functions only.

Defined cases: a null text counts as the empty text; a null ``doc_id`` loses to
any other, and stays only if all ids of its group are null; rows that repeat both
``doc_id`` and text are one document and get the same answer; an empty batch
appends nothing; extra columns of any name are ignored. Digests already in the
index keep the document recorded there, so a batch that is replayed after a
failure gets the same answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import fresh_path, shuffle_partitions, table, written

_SCHEMA = "digest binary, keep_id bigint, group_size bigint"


class DigestIndex:
    """A bucketed table of digests: ``digest``, the document that stays, rows seen with it."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        if not spark.catalog.tableExists(name):
            self._append(spark.createDataFrame([], _SCHEMA))

    def _append(self, rows: DataFrame) -> None:
        (
            rows.write.mode("append")
            .format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )

    def add(self, docs: DataFrame) -> DataFrame:
        """Add ``docs`` (doc_id, text); returns doc_id, digest, keep_id, group_size, kept for each row.

        ``group_size`` counts the rows of the batch that first brought the digest.
        """
        rows = written(
            docs.select(
                F.col("doc_id").cast("bigint").alias("doc_id"),
                F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"),
            ),
            "digests",
        )
        batch = rows.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        index = self.spark.read.table(self.name)
        self._append(batch.join(index.select("digest").hint("merge"), "digest", "left_anti"))
        # read as plain files: both sides are then shuffled, and the engine can split a hot digest
        found = self.spark.read.schema(_SCHEMA).parquet(self.path)
        return rows.join(found.hint("merge"), "digest").select(
            "doc_id",
            "digest",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its identical texts that stays."""
    path = fresh_path(spark, "digest-index")
    index = DigestIndex(spark, "digests_" + path[-32:], path, shuffle_partitions(spark))
    out = index.add(table(spark, sf_dir, "documents"))
    spark.sql(f"DROP TABLE {index.name}")  # the files stay; only this run's name goes
    return out.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP2_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
