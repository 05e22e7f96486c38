"""ZIP releases: member scan (S4) and archive audit.

A ZIP member cannot be split, so the scan is a Python Data Source with one
input partition per member. Each task streams its member in chunks and hands
Arrow batches of raw line bytes to Spark; decoding, CR removal and blank-line
dropping are the same Spark expressions as for plain files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from regline.session import ship_package
from regline.sources.text import lines_from_raw, list_files

# The audit calls archives whose members add up to more than
# 10 GiB oversize (exactly 10 GiB passes); only member names ending in
# lower-case ".csv" are read.
MAX_TOTAL_BYTES = 10 * 1024**3
MEMBER_SUFFIX = ".csv"
CHUNK_BYTES = 8 * 1024 * 1024
SPLIT_BYTES = 128 * 1024 * 1024  # uncompressed members above this are read by several tasks
SPREAD_BYTES = 256 * 1024 * 1024  # a compressed member above this has its lines spread after inflating

RAW_SCHEMA = "file_path string, file_name string, value binary"


def inspect_archive(uri: str, detail: bool = False) -> tuple[bool, list]:
    """(is_zip, [(member, uncompressed size)]) from the central directory only.

    With ``detail``, members are (name, size, stored, data_offset): whether
    the member is uncompressed and where its bytes start in the archive.
    """
    import struct
    import zipfile

    from regline.sources import fs

    with fs.open_input(uri) as handle:
        if handle.size() < 22:  # shorter than an end-of-archive record
            return False, []
        try:
            with zipfile.ZipFile(handle) as zf:
                infos = [i for i in zf.infolist() if not i.is_dir()]
                if not detail:
                    return True, [(i.filename, i.file_size) for i in infos]
                out = []
                for i in infos:
                    stored = i.compress_type == zipfile.ZIP_STORED and not i.flag_bits & 0x1
                    offset = -1
                    if stored:
                        handle.seek(i.header_offset)
                        head = handle.read(30)
                        name_len, extra_len = struct.unpack("<HH", head[26:30])
                        offset = i.header_offset + 30 + name_len + extra_len
                    out.append((i.filename, i.file_size, stored, offset))
                return True, out
        except zipfile.BadZipFile:
            return False, []


class MemberPartition(InputPartition):
    """A whole member, or for an uncompressed member the lines that begin in
    the byte range [start, end) of its content."""

    def __init__(self, archive: str, member: str, start: int = 0, end: int = -1, offset: int = -1, size: int = 0):
        super().__init__((archive, member, start, end))
        self.archive = archive
        self.member = member
        self.start = start
        self.end = end
        self.offset = offset
        self.size = size


def lines_in_range(read_at, start: int, end: int, chunk: int):
    """Lines whose first byte lies in [start, end) of a byte stream, as lists
    of lines or as blocks (bytes) of complete lines joined by LF.

    ``read_at(pos, n)`` returns up to n bytes at pos. A line that begins before
    ``start`` belongs to the previous range, as in Hadoop's line splits.
    """
    pos = 0
    if start > 0:  # the first line of this range starts after the first LF at or after start - 1
        pos = start - 1
        while True:
            buf = read_at(pos, chunk)
            if not buf:
                return
            i = buf.find(b"\n")
            if i >= 0:
                pos += i + 1
                break
            pos += len(buf)
    rest, rest_start, off = b"", pos, pos
    while rest_start < end:
        buf = read_at(off, chunk)
        if not buf:
            if rest:
                yield [rest]
            return
        off += len(buf)
        data = rest + buf
        cut = data.rfind(b"\n")
        if cut < 0:
            rest = data
            continue
        if rest_start + cut + 1 > end:  # the range ends inside this chunk
            keep, p = [], rest_start
            for line in data[:cut].split(b"\n"):
                if p >= end:
                    break
                keep.append(line)
                p += len(line) + 1
            yield keep
            return
        yield data[:cut]  # every line here starts inside the range: one block
        rest, rest_start = data[cut + 1:], rest_start + cut + 1


class ZipLinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.plan = json.loads(options["plan"])  # computed by plan_archives on executors
        self.chunk = int(options.get("chunkBytes", CHUNK_BYTES))

    def partitions(self):
        return [MemberPartition(*p) for p in self.plan]

    def read(self, partition: MemberPartition):
        """Batches of lines. A member that cannot be read to its end gives what
        it has, then a row without value."""
        import zipfile
        import zlib

        import pyarrow as pa

        try:
            yield from self._read(partition)
        except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):
            path = f"{partition.archive}#{partition.member}"
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([partition.member]), pa.array([None], pa.binary())],
                names=["file_path", "file_name", "value"],
            )

    def _read(self, partition: MemberPartition):
        import zipfile

        import pyarrow as pa
        import pyarrow.compute as pc

        from regline.sources import fs

        path = f"{partition.archive}#{partition.member}"

        def const(value, n):
            return pc.fill_null(pa.nulls(n, pa.string()), value)

        def batch(lines):
            n = len(lines)
            return pa.RecordBatch.from_arrays(
                [const(path, n), const(partition.member, n), pa.array(lines, pa.binary())],
                names=["file_path", "file_name", "value"],
            )

        def block_batch(block: bytes):
            """Complete lines joined by LF, split in Arrow (no Python object per line)."""
            values = pc.split_pattern(pa.array([block], pa.large_binary()), pattern=b"\n").flatten().cast(pa.binary())
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [const(path, n), const(partition.member, n), values], names=["file_path", "file_name", "value"]
            )

        if partition.end >= 0:  # a byte range of an uncompressed member
            with fs.open_input(partition.archive) as handle:

                def read_at(pos, n):
                    if pos >= partition.size:
                        return b""
                    handle.seek(partition.offset + pos)
                    return handle.read(min(n, partition.size - pos))

                for part in lines_in_range(read_at, partition.start, partition.end, self.chunk):
                    yield block_batch(part) if isinstance(part, bytes) else batch(part)
            return

        with fs.open_input(partition.archive) as handle, zipfile.ZipFile(handle) as zf, zf.open(partition.member) as src:
            rest = b""
            while True:
                chunk = src.read(self.chunk)
                if not chunk:
                    break
                data = rest + chunk
                cut = data.rfind(b"\n")
                if cut < 0:
                    rest = data
                    continue
                rest = data[cut + 1:]
                yield block_batch(data[:cut])
            if rest:
                yield batch([rest])


class ZipLinesDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "registry_zip"

    def schema(self) -> str:
        return RAW_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipLinesReader(self.options)


#: Sessions that know the data source; a stream's micro-batches run in one of their own.
_REGISTERED: WeakSet[SparkSession] = WeakSet()


def _register(spark: SparkSession) -> None:
    ship_package(spark)
    if spark not in _REGISTERED:
        spark.dataSource.register(ZipLinesDataSource)
        _REGISTERED.add(spark)


MEMBER_SCHEMA = "archive string, is_zip boolean, member string, size bigint, stored boolean, data_offset bigint"


def _member_rows(batches):
    import pandas as pd

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            is_zip, members = inspect_archive(path, detail=True)
            rows.extend((path, True, m, size, stored, off) for m, size, stored, off in members)
            if not members:
                rows.append((path, is_zip, None, 0, False, -1))
        yield pd.DataFrame(rows, columns=["archive", "is_zip", "member", "size", "stored", "data_offset"]).astype(
            {"size": "int64", "data_offset": "int64"}
        )


@dataclass
class ZipPlan:
    """What a ZIP load will read, from one executor-side pass over the
    central directories (metadata only reaches the driver)."""

    partitions: list  # (archive, member, start, end, offset, size)
    verdicts: dict  # archive -> ok | not_zip | oversize
    spread: int | None  # partitions to spread lines over, or None
    member_bytes: int


def plan_archives(
    spark: SparkSession,
    archives: Sequence[str],
    max_total_bytes: int | None = None,
    member_suffix: str = MEMBER_SUFFIX,
    split_bytes: int = SPLIT_BYTES,
    spread_bytes: int = SPREAD_BYTES,
) -> ZipPlan:
    """What to read of the archives: all members with the suffix, of all archives unless ``max_total_bytes`` is given.

    Inflating a member is sequential, but far cheaper per byte than parsing
    and writing its lines. When one compressed member is large (it may hold a
    third of a release), its task only inflates, and the lines are spread so
    the work after it runs on every core. Uncompressed members are split by
    byte range instead.
    """
    ship_package(spark)
    paths = spark.createDataFrame([(a,) for a in archives], "path string")
    n = max(1, min(len(archives), spark.sparkContext.defaultParallelism * 4))
    rows = paths.repartition(n, "path").mapInPandas(_member_rows, MEMBER_SCHEMA).collect()
    by_archive: dict = {}
    for r in rows:
        by_archive.setdefault(r.archive, []).append(r)
    partitions, verdicts, largest, total = [], {}, 0, 0
    for archive in archives:
        members = [r for r in by_archive.get(archive, []) if r.member is not None]
        if not any(r.is_zip for r in by_archive.get(archive, [])):
            verdicts[archive] = "not_zip"
            continue
        if max_total_bytes is not None and sum(r.size for r in members) > max_total_bytes:
            verdicts[archive] = "oversize"
            continue
        verdicts[archive] = "ok"
        for r in members:
            if not r.member.endswith(member_suffix):
                continue
            total += r.size
            if r.stored and r.size > split_bytes:
                partitions.extend(
                    (archive, r.member, s0, min(s0 + split_bytes, r.size), r.data_offset, r.size)
                    for s0 in range(0, r.size, split_bytes)
                )
            else:
                partitions.append((archive, r.member, 0, -1, -1, 0))
                if not r.stored:
                    largest = max(largest, r.size)
    cores = spark.sparkContext.defaultParallelism
    spread = max(2 * cores, -(-total // SPLIT_BYTES)) if largest > spread_bytes else None
    return ZipPlan(partitions, verdicts, spread, total)


def read_planned_raw(spark: SparkSession, plan: ZipPlan, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """S4 from a plan: raw lines; a row without value marks a member that could not be read to its end."""
    _register(spark)
    reader = spark.read.format("registry_zip").option("plan", json.dumps(plan.partitions))
    raw = reader.option("chunkBytes", str(chunk_bytes)).load()
    return raw.repartition(plan.spread) if plan.spread else raw  # raw bytes move once; decoding runs after the spread


def lines_of_planned(raw: DataFrame, encoding: str = "ISO-8859-1") -> DataFrame:
    return lines_from_raw(raw.where(F.col("value").isNotNull()), encoding)


def read_zip_lines(
    spark: SparkSession,
    archives: Sequence[str],
    encoding: str = "ISO-8859-1",
    max_total_bytes: int | None = None,
    split_bytes: int = SPLIT_BYTES,
    spread_bytes: int = SPREAD_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Lines of every accepted member of the given archives (see ``plan_archives``)."""
    plan = plan_archives(spark, archives, max_total_bytes, split_bytes=split_bytes, spread_bytes=spread_bytes)
    if not plan.partitions:
        return spark.createDataFrame([], "file_path string, file_name string, line string")
    return lines_of_planned(read_planned_raw(spark, plan, chunk_bytes), encoding)


def _audit_batches(batches):
    import pandas as pd

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            is_zip, members = inspect_archive(path)
            rows.append(
                (
                    path,
                    is_zip,
                    len(members),
                    sum(1 for m, _ in members if m.endswith(MEMBER_SUFFIX)),
                    sum(size for _, size in members),
                )
            )
        yield pd.DataFrame(rows, columns=["path", "is_zip", "members", "csv_members", "total_bytes"]).astype(
            {"members": "int64", "csv_members": "int64", "total_bytes": "int64"}
        )


def verdict(is_zip, total_bytes, max_total_bytes: int = MAX_TOTAL_BYTES):
    """not_zip | oversize (strictly above the limit) | ok."""
    return (
        F.when(~is_zip, F.lit("not_zip"))
        .when(total_bytes > F.lit(max_total_bytes), F.lit("oversize"))
        .otherwise(F.lit("ok"))
    )


def archive_audit(spark: SparkSession, root: str, max_total_bytes: int = MAX_TOTAL_BYTES) -> DataFrame:
    """Per archive: is it a ZIP, members, .csv members, uncompressed bytes, verdict.

    Central directories are read by executors, one archive per row.
    """
    ship_package(spark)
    listing = list_files(spark, root, glob="*.zip").select("path", "file_name")
    n = max(1, min(1000, spark.sparkContext.defaultParallelism))
    audited = listing.repartition(n, "path").mapInPandas(
        _audit_batches, "path string, is_zip boolean, members bigint, csv_members bigint, total_bytes bigint"
    )
    return audited.join(listing, "path").select(
        F.col("file_name").alias("archive"),
        "is_zip",
        "members",
        "csv_members",
        "total_bytes",
        verdict(F.col("is_zip"), F.col("total_bytes"), max_total_bytes).alias("verdict"),
    )
