"""Exact dedup against a persistent digest index (native).

The index is a table bucketed and sorted by digest.  A new batch is reduced to
one row per digest, a sort-merge anti-join finds the digests that the index
lacks (the index side needs no shuffle), and those are appended.

Texts are equal when they are identical after deleting every character of
[\\x20\\x09-\\x0D]; a null counts as empty.  Of equal texts in one batch the one
with the most code points in its original text stays, ties to the smallest
doc_id.  A text that an earlier batch has already put into the index is a
duplicate of that earlier document.  Repeated rows (same doc_id, same text) are
all marked alike; ``deduplicate`` returns one of them.  Very long texts are digested
whole where they lie; only digests are shuffled.  An empty table gives an empty
result.  Other columns are ignored by ``decide``, whatever their names.

Buckets: a fresh index gets one for every ROWS_PER_BUCKET rows of its first batch,
at least as many as the session has shuffle partitions.  The number is kept beside
the index; ``regrown`` copies an index that has grown into one with more.

Skew: a digest that a third of all rows share is reduced map-side; the join back
to the rows carries no text and is one AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformkit.session import path_exists, read_small_text, scratch_path, scratch_table, write_small_text

from .common import columns, table, without_white, written


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, code points of the text, digest of the normalised text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), F.length(text).alias("n_points"),
                       F.sha2(without_white(text), 256).alias("digest"))


ROWS_PER_BUCKET = 1 << 20  # some 100 MB of digests: what one task sorts


def bucket_count(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BUCKET))


class DigestIndex:
    """A table (digest, keep_id, n_points) bucketed and sorted by digest.

    ``path`` is a shared folder.  Opening it again, in any session, goes on with
    what is there, in as many buckets as it was made with."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        mark = f"{path.rstrip('/')}/_buckets"
        if path_exists(spark, mark):
            buckets = int(read_small_text(spark, mark))
        else:
            buckets = buckets or bucket_count(spark, 0)
            write_small_text(spark, mark, str(buckets))
        self.spark, self.buckets = spark, buckets
        self.name = scratch_table(spark, "digest_index")
        spark.sql(f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT, n_points INT) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, batch: DataFrame) -> None:
        """Append the batch's digests that the index lacks, each with its row
        that stays.  ``batch`` has the columns of ``digests``."""
        best = (batch.groupBy("digest")
                .agg(F.min(F.struct((-F.col("n_points")).alias("o"), "doc_id")).alias("b")))
        new = (best.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")
               .select("digest", F.col("b.doc_id").alias("keep_id"),
                       (-F.col("b.o")).cast("int").alias("n_points")))
        # Hash partitioning into as many tasks as buckets: each writes one bucket file.
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.insertInto(self.name))


def decide(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Add a batch to the index; one row per document of the batch: doc_id,
    keep_id, group_size (rows of the batch with this text), kept, text_sha256."""
    rows = written(digests(docs), "digests")
    index.add(rows)
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = sizes.join(index.rows().select("digest", "keep_id"), "digest")
    return (rows.join(groups, "digest")
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = written(digests(docs), "digests")
    index.add(rows)
    keep = index.rows().select("digest", F.col("keep_id").alias("doc_id"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    marked = (docs.select(F.struct(*columns(docs)).alias("row"))
              .withColumn("digest", F.sha2(without_white(text), 256))
              .withColumn("doc_id", F.col("row.doc_id")))
    # Only a stayer's own id and digest match, so a hot text meets one row here.
    same = (F.col("m.digest") == F.col("k.digest")) & F.col("m.doc_id").eqNullSafe(F.col("k.doc_id"))
    return (marked.alias("m").join(keep.alias("k"), same, "left_semi")
            .dropDuplicates(["digest", "doc_id"]).select("row.*"))


def fresh_index(spark: SparkSession, rows: int = 0) -> DigestIndex:
    """A new index in the scratch folder, for a first batch of so many rows."""
    return DigestIndex(spark, scratch_path(spark, "digest_index"), bucket_count(spark, rows))


def regrown(index: DigestIndex, path: str) -> DigestIndex:
    """A copy of an index at ``path``, with buckets for the rows it has now."""
    rows = index.rows()
    new = DigestIndex(index.spark, path, bucket_count(index.spark, rows.count()))
    rows.repartition(new.buckets, "digest").sortWithinPartitions("digest").write.insertInto(new.name)
    return new


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decide(docs, fresh_index(spark, docs.count()))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
"""
