"""Exact dedup against a persistent index of digests, bucketed and sorted by digest."""

from __future__ import annotations

import hashlib
import string
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.llm.common import LOWER, join_groups, number, numbered, pick, read, small, texts
from hotrank.session import as_table, fresh_folder

#: Digests of one bucket of a new index.
PER_BUCKET = 4_000_000
_LEAST_BUCKETS = 8


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest``: SHA-256 of each text with A-Z in lower case; null texts count as empty."""

    def run(batches):
        for batch in small(batches):
            found = [hashlib.sha256(x.translate(LOWER)).digest() for x in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "digest"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, digest binary")


class DigestIndex:
    """The digests seen so far, with the id that stands for each.

    A Parquet table at ``path``, bucketed and sorted by digest, so that a new batch meets it in a
    sort-merge join for which the index is not shuffled. It outlives the session: opened again
    with the same path and number of buckets it goes on. One writer at a time. A batch that is
    added again finds its digests there and appends nothing.
    """

    _COLUMNS = "digest BINARY, keep_id BIGINT"

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark = spark
        self.path = path
        self.buckets = buckets
        # The catalog only names what lies at the path.
        self.name = f"digest_index_{uuid.uuid4().hex}"
        location = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.name} ({self._COLUMNS}) USING parquet CLUSTERED BY (digest) "
            f"SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def entries(self) -> DataFrame:
        """``digest, keep_id``, one row per digest."""
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forgets the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The digests of ``batch`` (``doc_id, digest``) not in the index, with their largest id.

        Copies within the batch are reduced inside tasks first, so no task holds a group.
        """
        groups = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        laid_out = groups.repartition(self.buckets, "digest")
        return laid_out.hint("merge").join(self.entries(), "digest", "left_anti")

    def add(self, batch: DataFrame) -> None:
        """Appends what is new in ``batch``; entries that are there already stand."""
        fresh = self.fresh(batch)
        # One file per bucket: rows of a bucket come from one task.
        fresh = fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest")
        fresh.select("digest", "keep_id").write.insertInto(self.name)


def deduplicate(
    docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``; one row per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z. Of equal texts of ``docs`` the largest
    id stays, unless the index held the text before: then that entry's id stands and no row of
    ``docs`` stays. ``group_size`` counts rows of ``docs``. Larger ids go into the index before
    smaller ones, half by half, so the entry first written is the one that stays.

    Null texts count as empty, null ids as the smallest; rows of one id and text count as one
    document of several rows, all kept. Empty tables give no rows; other columns are not
    looked at. Digests alone are shuffled, 32 bytes a text, however long it is.

    Groups above a thousandth of all rows, at most a thousand, meet their rows by broadcast, so
    no task gets a hot group whole.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = as_table(digests(rows), fresh_folder(spark, "digests"))
    sizes = found.agg(
        F.count("*").alias("n"), F.percentile_approx("doc_id", 0.5).alias("middle")).first()
    own = index is None
    if own:
        buckets = max(_LEAST_BUCKETS, -(-sizes.n // PER_BUCKET))
        index = DigestIndex(spark, fresh_folder(spark, "digest-index"), buckets)
    try:
        upper = F.coalesce(F.col("doc_id") > F.lit(sizes.middle), F.lit(False))
        index.add(found.where(upper))
        index.add(found.where(~upper))
        groups = found.groupBy("digest").agg(F.count("*").alias("group_size"))
        groups = as_table(
            groups.hint("merge").join(index.entries(), "digest"), fresh_folder(spark, "digest-groups"))
    finally:
        if own:
            index.close()
    return join_groups(found, groups, "digest", "group_size", sizes.n).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are; of rows of one id and text, one."""
    doc_id, text = number(docs, "doc_id"), number(docs, "text")
    upper = string.ascii_uppercase
    lowered = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    rows = numbered(docs).withColumn("sha", F.sha2(lowered.cast("binary"), 256))
    kept = deduplicate(docs, index).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")).distinct()
    same = F.col(doc_id).eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha"))
    return (
        rows.join(kept, same, "left_semi").dropDuplicates([doc_id, "sha"]).drop("sha")
        .toDF(*docs.columns)
    )


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(read(spark, folder, "documents"))
