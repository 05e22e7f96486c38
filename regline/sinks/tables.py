"""Stored table: ensure (S11), append (S9), layout + statistics (S12),
bounded output files (S13), relational target over JDBC (S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.layout import EMPRESAS, Layout
from regline.sinks.commits import Commits


def table_ddl(name: str, layout: Layout = EMPRESAS, location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS with VARCHAR(n) limits (Spark enforces them on write)."""
    cols = ", ".join(f"`{f.name}` {f'VARCHAR({f.width})' if f.width else 'STRING'}" for f in layout.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet"
    if layout.partition_by:
        ddl += f" PARTITIONED BY ({', '.join(layout.partition_by)})"
    if location:
        ddl += f" LOCATION '{location}'"
    return ddl


def ensure_table(spark: SparkSession, name: str, layout: Layout = EMPRESAS, location: str | None = None) -> None:
    """Create if absent; an existing table (even a different one) is left alone."""
    spark.sql(table_ddl(name, layout, location))


def laid_out(records: DataFrame, layout: Layout = EMPRESAS, sort_by: tuple[str, ...] | None = None) -> DataFrame:
    """Rows grouped by the partition column and sorted inside each file.

    ``rebalance`` lets AQE cut a hot partition value (a third of all rows in
    one uf, say) into several evenly sized tasks instead of one; rows are then
    sorted by (uf, cnae, cnpj) so min/max statistics of each file prune
    lookups on cnae and cnpj.
    """
    parts = list(layout.partition_by)
    order = [*parts, *(layout.sort_by if sort_by is None else sort_by)]
    out = records.hint("rebalance", *parts) if parts else records.hint("rebalance")
    return out.sortWithinPartitions(*order) if order else out


def append(
    records: DataFrame,
    name: str,
    layout: Layout = EMPRESAS,
    max_records_per_file: int | None = None,
) -> None:
    """Append by column name into the partitioned table, in layout order."""
    writer = laid_out(records.select(*layout.names), layout).write.mode("append").format("parquet")
    writer = writer.options(**layout.parquet_options())
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.saveAsTable(name)


def write_partitioned(
    records: DataFrame,
    path: str,
    layout: Layout = EMPRESAS,
    max_records_per_file: int | None = None,
    mode: str = "errorifexists",
    observation=None,
    only_partitions: bool = False,
) -> None:
    """S12 + S13: partitioned Parquet at a path, at most n rows per file.

    ``only_partitions``: overwriting replaces the partitions that ``records``
    has rows of and leaves the others.

    ``observation`` (a pyspark Observation) receives the written row count.
    It is attached after the last shuffle, in the writing stage itself, whose
    task results Spark applies once even when a lost executor forces a retry.
    """
    out = laid_out(records.select(*layout.names), layout)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("n"))
    writer = out.write.mode(mode).options(**layout.parquet_options())
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def table_schema(layout: Layout = EMPRESAS) -> str:
    return ", ".join(f"`{f.name}` string" for f in layout.fields)


def read_partitioned(spark: SparkSession, path: str, layout: Layout = EMPRESAS) -> DataFrame:
    """Read back with an explicit all-string schema, so a partition value such
    as uf=01 stays text whatever the session's type-inference setting. Of a
    table that loads were committed to, the committed ones are read."""
    commits = Commits(path)
    if commits.kept:
        return commits.read(spark, table_schema(layout)).select(*layout.names)
    return spark.read.schema(table_schema(layout)).option("basePath", path).parquet(path).select(*layout.names)


def write_snapshot(
    records: DataFrame,
    name: str,
    location: str,
    buckets: int,
    layout: Layout = EMPRESAS,
) -> DataFrame:
    """A release snapshot bucketed and sorted by key (D8, D5 at scale).

    Dealt out by key first, so each bucket is one sorted file. Two snapshots
    with the same bucket count join on the key with no shuffle at all (the
    full outer join of a release diff reads both sides bucket by bucket), and
    key lookups prune to one bucket. See ``plans.sizing.buckets_for``.
    """
    (
        records.select(*layout.names)
        .repartition(buckets, layout.key)
        .write.options(**layout.parquet_options())
        .bucketBy(buckets, layout.key)
        .sortBy(layout.key)
        .option("path", location)
        .saveAsTable(name)
    )
    return records.sparkSession.table(name)


def analyze(spark: SparkSession, name: str, columns: tuple[str, ...] = ("uf", "cnae_fiscal", "situacao_cadastral")) -> None:
    """Table and column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def rows_per_file(spark: SparkSession, path: str) -> DataFrame:
    """S13 check: rows in each written file, from Parquet footers' file metadata."""
    return (
        spark.read.option("basePath", path)
        .parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def write_jdbc(
    records: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    batch_size: int = 100_000,
    num_partitions: int | None = None,
) -> None:
    """S9 to a relational database (needs the database's JDBC driver on the classpath).

    Tasks commit independently, so write to a staging table and swap it in
    with the database's own DDL when the job has finished.
    """
    writer = records.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode("append").save()
