"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by digest, with one row per text ever admitted. A batch is
first reduced to one row per digest, so a group of copies of any size reaches the join as one row per map task;
the rows that a sort-merge anti-join finds no index entry for are appended. The index itself is never shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadgauge.session import scratch_dir, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 32


def digest(text: Column) -> Column:
    """SHA-256 (binary) of a text with A-Z lowered. A null text counts as empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), 256))


class DigestIndex:
    """Digests at a path that all executors reach; opened again by path, it goes on where it ended."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets, self.name = spark, buckets, f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"create table {self.name} (digest binary, keep_id bigint, keep_row bigint, batch string) using parquet"
            f" clustered by (digest) sorted by (digest) into {buckets} buckets location '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def admit(self, rows: DataFrame) -> str:
        """Append what is new of (doc_id, row_id, digest). Returns the batch's name.

        Within a batch the largest doc_id is entered (a null id is the smallest; of repeated rows one is taken).
        A digest of an earlier batch keeps its entry.
        """
        batch = uuid.uuid4().hex
        fresh = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row_id")).alias("best"))
        known = self.table().select("digest").hint("merge")
        new = fresh.join(known, "digest", "left_anti").select(
            "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"), F.lit(batch).alias("batch"))
        # one file per bucket and batch
        new.repartition(self.buckets, "digest").write.insertInto(self.name)
        return batch


def deduplicate(docs: DataFrame, index: DigestIndex, batches: int = 2) -> DataFrame:
    """Decide on every row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are admitted in batches of falling doc_id, so of equal texts new to the index the row with the largest
    doc_id stays; texts the index knew before stay nowhere and name the entry's id. group_size counts the rows of
    this call. Of rows that repeat both id and text one stays. An empty table gives no rows.
    """
    rows = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row_id"),
        digest(F.col("text")).alias("digest")), "digests")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    key, admitted = F.coalesce(F.col("doc_id"), F.lit(-1 << 63)), []
    if high is None or high == low:
        admitted.append(index.admit(rows))
    else:
        step, top = max((high - low) // batches + 1, 1), None
        for i in range(batches):
            bound = high - step * (i + 1) if i < batches - 1 else None
            part = rows if bound is None else rows.where(key > bound)
            part = part if top is None else part.where(key <= top)
            admitted.append(index.admit(part))
            top = bound
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    entries = stage(sizes.join(index.table(), "digest").select(
        "digest", "keep_id", "group_size",
        F.when(F.col("batch").isin(admitted), F.col("keep_row")).alias("keep_row")), "entries")
    return rows.join(entries, "digest").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("row_id") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def survivors(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of docs that stay, all columns unchanged. Rows without doc_id have no identity and all stay."""
    kept = (
        deduplicate(docs, index).where("kept").where("doc_id is not null")
        .select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__digest"))
    )
    named = docs.withColumn("__digest", digest(F.col("text"))).withColumn("__id", F.col("doc_id").cast("long"))
    stay = named.join(kept, ["__id", "__digest"], "left_semi").dropDuplicates(["__id", "__digest"])
    return stay.unionByName(named.where("__id is null")).select(*docs.columns)


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared scratch folder."""
    return DigestIndex(spark, scratch_dir(spark, "digest-index"))
