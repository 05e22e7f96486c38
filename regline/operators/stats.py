"""Run statistics: counters (M1), rates (M2), per-file report (M3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.operators.records import REASONS

STATS_SCHEMA = (
    "lines_read bigint, records_processed bigint, rejected_too_few_fields bigint, "
    "rejected_bad_cnpj_width bigint, rejected_overwide bigint, duplicates_dropped bigint, "
    "records_written bigint, files_read bigint, files_failed bigint, bytes_read bigint, "
    "batches_sent bigint, records_filtered bigint, already_stored bigint, files_left_out bigint, errors bigint"
)


def counter_columns() -> list[Column]:
    """Aggregates over a classified DataFrame; usable in ``observe`` and ``agg``."""
    reason = F.col("reason")
    return [
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(reason.isNull()).alias("records_processed"),
        *[F.count_if(reason == F.lit(r)).alias(f"rejected_{r}") for r in REASONS],
    ]


def batches_for(records: int, batch_size: int) -> int:
    """M1: output chunks of ``batch_size``; the last may be short; none for none."""
    return -(-records // batch_size) if records > 0 else 0


def stats_values(values: dict) -> dict:
    """The counters of ``STATS_SCHEMA`` in its order, absent ones 0.

    errors = rejected lines + unreadable files + failed batches (always 0
    here: a bad row is quarantined instead of failing its batch).
    """
    names = [field.split()[0] for field in STATS_SCHEMA.split(", ")]
    row = {name: int(values.get(name, 0)) for name in names if name != "errors"}
    return {**row, "errors": sum(row[f"rejected_{r}"] for r in REASONS) + row["files_failed"]}


def stats_frame(spark: SparkSession, values: dict) -> DataFrame:
    """One-row statistics DataFrame from already computed counters."""
    return spark.createDataFrame([tuple(stats_values(values).values())], STATS_SCHEMA)


def summed(stats: DataFrame) -> DataFrame:
    """M1 over several loads or micro-batches: each counter's sum, 0 where there was none."""
    names = [field.split()[0] for field in STATS_SCHEMA.split(", ")]
    return stats.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])


def with_rates(stats: DataFrame, elapsed_secs: float) -> DataFrame:
    """M2: records/s and MiB/s over ``elapsed_secs``; 0.0 when elapsed is 0."""
    elapsed = F.lit(float(elapsed_secs))
    positive = elapsed > 0
    return stats.select(
        "*",
        elapsed.alias("elapsed_secs"),
        F.when(positive, F.col("records_written") / elapsed).otherwise(F.lit(0.0)).alias("records_per_sec"),
        F.when(positive, F.col("bytes_read") / F.lit(1048576.0) / elapsed).otherwise(F.lit(0.0)).alias("mb_per_sec"),
    )


def per_file_report(classified: DataFrame, listing: DataFrame) -> DataFrame:
    """M3: per file: bytes, non-blank lines, accepted, and rejects by reason.

    Right-joined with the listing so that empty files show up with zeros.
    """
    reason = F.col("reason")
    per_file = classified.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(reason.isNull()).alias("accepted"),
        *[F.count_if(reason == F.lit(r)).alias(r) for r in REASONS],
    )
    counts = ["lines", "accepted", *REASONS]
    return listing.select("file_name", F.col("length").alias("bytes")).join(per_file, "file_name", "left").select(
        "file_name", "bytes", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts]
    )
