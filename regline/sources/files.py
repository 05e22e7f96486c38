"""Release folders as data: listing (S6), checksums (S7), already-ingested skip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.session import ship_package
from regline.sources.text import list_files

HASH_CHUNK = 8 * 1024 * 1024


def cache_listing(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Archives in a folder, by name, size in MiB; empty if the folder is missing."""
    return (
        list_files(spark, root, glob)
        .select("file_name", "path", "length", (F.col("length") / F.lit(1024 * 1024)).alias("size_mib"))
        .orderBy("file_name")
    )


def _hash_batches(batches):
    import hashlib

    import pandas as pd

    from regline.sources import fs

    for pdf in batches:
        digests = []
        for path in pdf["path"]:
            h = hashlib.sha256()
            with fs.open_input(path) as handle:
                while True:
                    chunk = handle.read(HASH_CHUNK)
                    if not chunk:
                        break
                    h.update(chunk)
            digests.append(h.hexdigest())
        yield pdf.assign(sha256=pd.Series(digests, dtype=object, index=pdf.index))


def with_sha256(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Add the hex SHA-256 of each listed file.

    Files are streamed in chunks by executors (one file per row), so size is
    not limited by the 2 GiB cap on ``binaryFile`` content and memory stays
    flat; hashing itself runs in C.
    """
    ship_package(spark)
    n = max(1, spark.sparkContext.defaultParallelism)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in listing.schema.fields) + ", sha256 string"
    return listing.repartition(n, "path").mapInPandas(_hash_batches, schema)


def verify_checksums(spark: SparkSession, root: str, manifest: DataFrame, glob: str | None = None) -> DataFrame:
    """(file_name, expected_sha256) manifest vs. files on disk.

    status: ok | mismatch | unchecked (no expected value) | missing (listed in
    the manifest, not on disk).
    """
    actual = with_sha256(spark, list_files(spark, root, glob).select("path", "file_name", "length"))
    joined = actual.join(manifest, "file_name", "full")
    status = (
        F.when(F.col("path").isNull(), F.lit("missing"))
        .when(F.col("expected_sha256").isNull(), F.lit("unchecked"))
        .when(F.lower("expected_sha256") == F.col("sha256"), F.lit("ok"))
        .otherwise(F.lit("mismatch"))
    )
    return joined.select("file_name", "length", "sha256", "expected_sha256", status.alias("status"))


def not_yet_ingested(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates (file_name, length[, sha256]) minus files already taken.

    A ledger row matches when name and length are equal and so are path,
    modification time and SHA-256, as far as both sides have them: the same
    name comes again with every release.
    """
    c, led = candidates.alias("c"), ledger.alias("l")
    same = (F.col("c.file_name") == F.col("l.file_name")) & (F.col("c.length") == F.col("l.length"))
    for known in ("path", "modification_time", "sha256"):
        if known in candidates.columns and known in ledger.columns:
            either_unknown = F.col(f"l.{known}").isNull() | F.col(f"c.{known}").isNull()
            same = same & (either_unknown | (F.col(f"c.{known}") == F.col(f"l.{known}")))
    return c.join(led, same, "left_anti")
