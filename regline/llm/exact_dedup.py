"""Exact de-duplication against a persistent digest index. DataFrame/SQL only.

The index is a Parquet table, bucketed and sorted by digest, with one row per
distinct text seen so far. A batch is reduced to one row per digest by a
partially aggregated ``max``, judged against the index, anti-joined
(sort-merge; the bucketed side is not shuffled) with it, and what is new is
appended.

Digests carry the name of their batch. A batch that is run again under its
name, after a failure at any point, meets its own digests as its own and is
judged as before. Each batch adds one sorted file to a bucket; when a bucket
has COMPACT_FILES, the buckets are rewritten as one sorted file each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.llm.common import free_name, text_or_empty, written
from regline.plans.ingest import sql_conf
from regline.session import fresh_dir
from regline.sources import fs

#: Files of a bucket from which on the index is compacted.
COMPACT_FILES = 8
#: A file in a folder whose index went to another one; names that one.
_MOVED = "_moved_to"


def digest(text: Column) -> Column:
    """32-byte SHA-256 of the text in UTF-8; null counts as empty."""
    # The coalesce only tells the planner that it is never null.
    return F.coalesce(F.unhex(F.sha2(text_or_empty(text), 256)), F.lit(bytearray()))


def open_index(spark: SparkSession, name: str | None = None, location: str | None = None, buckets: int | None = None) -> str:
    """Create the index table, or attach to the files a former session left at ``location``.

    ``buckets`` must be the same each time a location is opened; unset, it is
    the session's number of shuffle partitions. Returns the table's name.
    """
    name = name or f"digest_index_{uuid.uuid4().hex[:10]}"
    location = location or fresh_dir(spark, "digest-index")
    while fs.exists(f"{location}/{_MOVED}"):
        with fs.open_input(f"{location}/{_MOVED}") as pointer:
            location = pointer.read().decode()
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return name


def compact(spark: SparkSession, index: str) -> None:
    """Rewrite the index with one sorted file in each bucket, at a new location, which the table and the old location
    then point to. The buckets are not shuffled. A failure before that leaves the index as it was."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {index}").collect()}
    old = described["Location"]
    new, copy = fresh_dir(spark, "digest-index"), f"{index}_{uuid.uuid4().hex[:8]}"
    with sql_conf(spark, **{"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):  # a task for each bucket
        spark.sql(
            f"CREATE TABLE {copy} USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {described['Num Buckets']} BUCKETS LOCATION '{new}' AS SELECT * FROM {index}"
        )
    fs.write_bytes(f"{old}/{_MOVED}", new.encode())
    spark.sql(f"ALTER TABLE {index} SET LOCATION '{new}'")
    spark.sql(f"DROP TABLE {copy}")  # the table has a location of its own: its files stay


def dedup_batch(
    batch: DataFrame, index: str, id_col: str = "doc_id", text_col: str = "text", name: str | None = None
) -> DataFrame:
    """Judge every row of ``batch`` against the index and its own copies; append new digests.

    Returns one row per input row: ``id, digest, keep_id, group_size, kept``.
    ``keep_id`` is the id in the index, so of texts seen first in this batch
    the largest id, and of texts seen in an earlier batch the id kept then.
    ``group_size`` counts the batch's rows of that text. Null text counts as
    empty. A null id is smaller than any other and is kept only if all ids of
    its text are null. Of rows equal in text and id exactly one is kept;
    which one can differ from run to run. An empty batch gives no rows and
    leaves the index as it is. Under the ``name`` of an earlier batch that
    one's digests are this batch's own: the same rows are judged as they were.
    Without a name each call is a new batch.
    """
    spark = batch.sparkSession
    this = name or uuid.uuid4().hex
    # The row number tells repeated rows apart; writing the table fixes it.
    rows = written(
        batch.select(
            F.col(id_col).cast("bigint").alias("id"),
            digest(F.col(text_col)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    # Written, or the planner would move the joins below the sum and shuffle every copy.
    groups = written(
        rows.groupBy("digest")
        .agg(F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"),
        "groups",
    )
    spark.catalog.refreshTable(index)
    buckets = _buckets(spark, index)
    if len(spark.table(index).inputFiles()) >= COMPACT_FILES * buckets:
        compact(spark, index)
    others = spark.table(index).where(F.col("batch") != this).select("digest", F.col("keep_id").alias("stored_id"), F.lit(1).alias("seen"))
    # Written before the index changes, and so that the join below shuffles both
    # sides itself and AQE may split a digest that a third of all rows share.
    owners = written(
        groups.hint("merge").join(others.hint("merge"), "digest", "left").select(
            "digest",
            "group_size",
            F.when(F.col("seen").isNull(), F.col("keep_id")).otherwise(F.col("stored_id")).alias("keep_id"),
            F.when(F.col("seen").isNull(), F.col("keep_row")).alias("keep_row"),
        ),
        "owners",
    )
    stored = spark.table(index).select("digest")
    new = groups.hint("merge").join(stored.hint("merge"), "digest", "left_anti")
    # One file per bucket and batch, each sorted.
    (
        new.select("digest", "keep_id", F.lit(this).alias("batch"))
        .repartition(buckets, "digest")
        .write.mode("append")
        .insertInto(index)
    )
    return rows.join(owners, "digest").select(
        "id",
        "digest",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
    )


def _buckets(spark: SparkSession, index: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {index}").where("col_name = 'Num Buckets'").first()
    return int(described.data_type)


def keep_first_copies(
    docs: DataFrame, index: str, id_col: str = "doc_id", text_col: str = "text", name: str | None = None
) -> DataFrame:
    """The rows of ``docs`` that ``dedup_batch`` keeps, with all their columns.

    Rows are dealt out by digest and id together, so the copies of one text
    spread over all tasks. Of rows equal in text and id, one stays whatever
    their other columns hold; which one can differ from run to run.
    """
    key = free_name(docs, "digest_and_id")

    def row_key(of: Column, ident: Column) -> Column:
        return F.concat(of, F.coalesce(ident.cast("bigint").cast("string").cast("binary"), F.lit(bytearray())))

    kept = dedup_batch(docs, index, id_col, text_col, name).where("kept")
    kept = kept.select(row_key(F.col("digest"), F.col("id")).alias(key))
    rows = docs.withColumn(key, row_key(digest(F.col(text_col)), F.col(id_col)))
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
