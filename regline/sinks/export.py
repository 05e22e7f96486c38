"""Exports: load-ready text (S10), Parquet / CSV files (D7), several sinks at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from regline.functions.columns import copy_text_line
from regline.layout import EMPRESAS, Layout


def copy_text(records: DataFrame, layout: Layout = EMPRESAS) -> DataFrame:
    """One tab-separated line per record, ``\\N`` for NULL, escaped."""
    return records.select(copy_text_line(layout.names).alias("value"))


def write_copy_text(records: DataFrame, path: str, layout: Layout = EMPRESAS, compression: str | None = None) -> None:
    writer = copy_text(records, layout).write.option("lineSep", "\n")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_export(records: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Parquet (snappy) or CSV with a header; CSV quotes with '"' and escapes '"' by doubling."""
    writer = records.write.mode(mode)
    if fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("compression", "gzip")
            .csv(path)
        )
    elif fmt == "json":
        writer.option("compression", "gzip").json(path)
    else:
        writer.format(fmt).save(path)


def read_export(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.format(fmt).schema(schema).load(path)


def fanout(records: DataFrame, targets: Sequence[tuple[str, str]]) -> None:
    """One accepted DataFrame to several (format, path) targets.

    The input is persisted on executor disk so the upstream scan and parse
    run once, not once per target; on a lost executor the missing blocks are
    recomputed from the source.
    """
    cached = records.persist(StorageLevel.DISK_ONLY)
    try:
        for fmt, path in targets:
            write_export(cached, path, fmt)
    finally:
        cached.unpersist()
