"""Delimited text files: line scan (S1, P1, P7), file lists (S2), selection (S3)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.functions.columns import decode_text, strip_line_end


def lines_from_raw(raw: DataFrame, encoding: str = "ISO-8859-1", keep_blank: bool = False) -> DataFrame:
    """(file_path, file_name, value[binary|string]) -> (file_path, file_name, line).

    Decodes first (before any regex), then removes one final CR, then drops
    zero-length lines. Shared by the plain-text, archive and streaming scans.
    """
    if not keep_blank:
        # Blank after removing one final CR <=> the raw bytes are "" or "\r";
        # testing the raw value avoids decoding twice when the filter is
        # pushed below the projection.
        raw = raw.where(~F.col("value").cast("binary").isin(F.lit(bytearray()), F.lit(bytearray(b"\r"))))
    return raw.select(
        "file_path",
        "file_name",
        strip_line_end(decode_text("value", encoding)).alias("line"),
    )


def read_raw(spark: SparkSession, paths: str | Sequence[str], line_sep: str = "\n", tolerant: bool = False) -> DataFrame:
    """Splittable text scan; lines end at LF only (a lone CR is data).

    ``tolerant``: a file that cannot be read ends where reading fails, and the
    others are read. Compare ``line_bytes`` with ``expected_bytes`` then: Spark
    itself doesn't say which files these were.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("lineSep", line_sep)
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        "value",
    )


def line_bytes() -> Column:
    """Bytes of the lines of ``read_raw``, line ends included: an aggregate, also for ``observe``."""
    return F.coalesce(F.sum(F.octet_length("value").cast("bigint") + 1), F.lit(0))


def expected_bytes(files: Iterable, threads: int = 32) -> dict[str, int | None]:
    """What ``line_bytes`` gives for each file (path, length) that is read to its end; None if it can't be opened.

    That is its length, and one more where its last line has no line end. One
    byte of each file is read.
    """
    from concurrent.futures import ThreadPoolExecutor

    from regline.sources import fs

    def expected(file) -> int | None:
        if not file.length:
            return 0
        try:
            with fs.open_input(file.path) as stream:
                stream.seek(file.length - 1)
                return file.length + (stream.read(1) != b"\n")
        except OSError:
            return None

    files = list(files)
    with ThreadPoolExecutor(threads) as pool:
        return dict(zip([f.path for f in files], pool.map(expected, files)))


def short_files(spark: SparkSession, expected: dict[str, int]) -> list[str]:
    """Paths of the files whose lines don't add up to ``expected``: reads them once more. Files of one name are judged together."""
    # Spark gives names as they stand in a URI.
    per_name: dict[str, int] = {}
    for path, n in expected.items():
        name = path.rsplit("/", 1)[-1]
        per_name[name] = per_name.get(name, 0) + n
    raw = read_raw(spark, list(expected), tolerant=True)
    found = {unquote(r.file_name): r.n for r in raw.groupBy("file_name").agg(line_bytes().alias("n")).collect()}
    return [path for path in expected if found.get(name := path.rsplit("/", 1)[-1], 0) != per_name[name]]


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str = "ISO-8859-1",
    keep_blank: bool = False,
) -> DataFrame:
    """S1 + P7 + P1: files -> non-blank decoded lines with their file."""
    return lines_from_raw(read_raw(spark, paths), encoding, keep_blank)


def list_files(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """File listing (path, file_name, length, modification_time); content is never read.

    Taken from the filesystem on the driver (metadata only, as Spark's own
    listing is) because Spark's file scans drop zero-length files, and an
    empty release file must still be reported. A missing folder lists empty.
    """
    import fnmatch

    from regline.sources import fs

    rows = [
        (uri, name, size, mtime)
        for uri, name, size, mtime in fs.list_dir(root, recursive)
        if glob is None or fnmatch.fnmatchcase(name, glob)
    ]
    return spark.createDataFrame(rows, "path string, file_name string, length bigint, modification_time timestamp")


def file_status(spark: SparkSession, root: str, names: Iterable[str]) -> DataFrame:
    """Wanted file names -> (file_name, path, length, status ok|missing)."""
    wanted = spark.createDataFrame([(n,) for n in names], "file_name string")
    listing = list_files(spark, root)
    return wanted.join(listing, "file_name", "left").select(
        "file_name",
        "path",
        "length",
        F.when(F.col("path").isNull(), F.lit("missing")).otherwise(F.lit("ok")).alias("status"),
    )


def read_file_list(
    spark: SparkSession, root: str, names: Iterable[str], encoding: str = "ISO-8859-1"
) -> tuple[DataFrame, DataFrame]:
    """Read the named files of ``root``; a missing one is reported, not fatal.

    Returns (lines, status). Only the small file listing reaches the driver.
    """
    status = file_status(spark, root, list(names))  # built from the driver-side listing; cheap to recompute
    present = [r.path for r in status.where("status = 'ok'").select("path").collect()]
    if present:
        lines = read_lines(spark, present, encoding)
    else:
        lines = spark.createDataFrame([], "file_path string, file_name string, line string")
    return lines, status


# Registry archive names look like <Family><n>.<ext>, e.g. Empresas3.zip.
DATASET_NAME = r"^([A-Za-z]+)([0-9]*)\."


def dataset_files(
    spark: SparkSession,
    root: str,
    families: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    glob: str | None = None,
) -> DataFrame:
    """S3: listing with dataset family and part number, and whether it is selected.

    Selected = in ``names`` when given, else family in ``families`` when
    given, else every file.
    """
    listing = list_files(spark, root, glob)
    part = F.regexp_extract("file_name", DATASET_NAME, 2)
    out = listing.select(
        "path",
        "file_name",
        "length",
        "modification_time",
        F.regexp_extract("file_name", DATASET_NAME, 1).alias("dataset"),
        F.when(part == "", F.lit(None)).otherwise(part).cast("int").alias("part_no"),
    )
    if names is not None:
        selected = F.col("file_name").isin(list(names))
    elif families is not None:
        selected = F.col("dataset").isin(list(families))
    else:
        selected = F.lit(True)
    return out.withColumn("selected", selected)
