"""Numbered chunks (S13) and sinks that take them one by one.

``with_chunks`` gives each record its chunk: all chunks have ``size`` records
but the last. A chunk is the batch of a sink: it is delivered whole or not at
all, a batch that the sink refuses is counted and set aside, and those before
and after it stay. Any class with the methods of ``Target`` is a sink.

A task writes to files of its own. Only files that the commit of the whole
write names are read, so a retried or speculative task counts once, and a
write that failed leaves nothing that a reader sees.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from regline.layout import EMPRESAS, Layout
from regline.plans.ingest import sql_conf
from regline.session import fresh_dir, ship_package, staged
from regline.sources import fs

REPORT = pa.schema([("batch", pa.int64()), ("rows", pa.int64()), ("sent", pa.bool_()), ("error", pa.string())])
REPORT_DDL = "batch bigint, rows bigint, sent boolean, error string"


def with_chunks(records: DataFrame, size: int, order_by: Sequence[str] = (), name: str = "chunk") -> DataFrame:
    """``records`` and the number of their chunk, from 0: ``ceil(n / size)`` chunks, all full but the last.

    The records are written once. A record's place is the number of records in
    the files before its own, a prefix sum over one row per file, plus its row
    number in the file: nothing is sorted for it, and a retried task finds the
    same places. With ``order_by`` they are dealt out by range first, so chunks
    follow that order (equal values in any order) and are the same however the
    input was partitioned. An empty input has no chunk.
    """
    if size < 1:
        raise ValueError(f"a chunk needs at least one record, got {size}")
    spark = records.sparkSession
    if order_by:
        records = records.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    path = fresh_dir(spark, "chunks")
    records.write.parquet(path)
    rows = spark.read.schema(records.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    # Files are named by task; past 99,999 tasks the names no longer sort as text.
    task = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(task, "_file").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    starts = staged(counts.select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")), "chunk-starts")
    place = F.col("_start") + F.col("_row")
    return rows.join(starts, "_file").select(*records.columns, F.floor(place / size).cast("bigint").alias(name))


def write_chunks(records: DataFrame, path: str, size: int, order_by: Sequence[str] = (), **options: str) -> None:
    """One Parquet file for each chunk, in a folder ``chunk=<number>`` of ``path``, which must not exist yet.

    Tasks write the files through Arrow: Hadoop's local file system starts
    several processes for each file, which takes most of the time of a small
    one. ``options`` are those of Spark's own writer, which then writes.
    """
    spark = records.sparkSession
    if options:
        with_chunks(records, size, order_by).repartition("chunk").write.options(**options).partitionBy("chunk").parquet(path)
        return
    if fs.exists(path):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {path} already exists.")
    codec = spark.conf.get("spark.sql.parquet.compression.codec").lower()
    ship_package(spark)
    spark.dataSource.register(ChunkFiles)
    chunked = with_chunks(records, size, order_by).repartition("chunk").sortWithinPartitions("chunk", *order_by)
    writer = chunked.write.format(ChunkFiles.name()).mode("append").option("path", path)
    writer.option("codec", {"uncompressed": "none", "lz4_raw": "lz4"}.get(codec, codec)).save()


def read_chunks(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_chunks`` wrote. A task lists many folders: by Spark's default one folder has a task of its own, up to 10,000."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    with sql_conf(spark, **{"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}):
        return spark.read.schema(schema).parquet(path)  # lists the folders here


@dataclass
class ChunksDone(WriterCommitMessage):
    name: str  # of the attempt, its folder and its files
    chunks: list[int]


class ChunkWriter(DataSourceArrowWriter):
    """Rows in the order of their chunk; a chunk's rows are all in one task.

    An attempt of a task writes below a hidden folder of its own, and the
    commit moves the files of the attempts that count, as Spark's own does.
    """

    ROW_GROUP = 128 * 1024 * 1024  # bytes held of a chunk

    def __init__(self, options: dict[str, str]):
        self.path, self.codec = options["path"].rstrip("/"), options["codec"]
        self.hidden = f"{self.path}/_temporary"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ChunksDone:
        import pyarrow.parquet as pq

        done, held, held_bytes, out, writer = ChunksDone(uuid.uuid4().hex, []), [], 0, None, None

        def flush() -> None:
            nonlocal held, held_bytes
            if held:
                rows = pa.Table.from_batches(held)
                writer.write_table(rows, row_group_size=rows.num_rows)
            held, held_bytes = [], 0

        def close() -> None:
            if writer is not None:
                flush()
                writer.close()
                out.close()

        for batch in iterator:
            rows = batch.drop_columns(["chunk"])
            for number, a, b in _runs(batch.column("chunk")) if batch.num_rows else ():
                if not done.chunks or number != done.chunks[-1]:
                    close()
                    done.chunks.append(number)
                    out = fs.open_output(f"{self.hidden}/{done.name}/chunk={number}/{self.file(done)}")
                    writer = pq.ParquetWriter(out, rows.schema, compression=self.codec)
                held.append(rows.slice(a, b - a))
                held_bytes += held[-1].nbytes
                if held_bytes >= self.ROW_GROUP:
                    flush()
        close()
        return done

    @staticmethod
    def file(done: ChunksDone) -> str:
        return f"part-{done.name}.parquet"

    def commit(self, messages: list[ChunksDone | None]) -> None:
        moves = [(m.name, f"chunk={n}/{self.file(m)}") for m in messages if m is not None for n in m.chunks]
        with ThreadPoolExecutor(32) as pool:
            list(pool.map(lambda m: fs.move(f"{self.hidden}/{m[0]}/{m[1]}", f"{self.path}/{m[1]}"), moves))
        fs.delete_dir(self.hidden)
        fs.write_bytes(f"{self.path}/_SUCCESS", b"")

    def abort(self, messages: list[ChunksDone | None]) -> None:
        fs.delete_dir(self.hidden)


class ChunkFiles(DataSource):
    """The Spark data source that ``write_chunks`` writes to."""

    @classmethod
    def name(cls) -> str:
        return "chunk_files"

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(dict(self.options))


class Refused(Exception):
    """A sink does not take a batch; the write goes on with the next."""


class Target:
    """A sink of one task. ``send`` takes a batch whole or raises ``Refused`` and takes nothing of it;
    any other error fails the task, which Spark then tries again with a new ``Target``."""

    def __init__(self, path: str, options: dict[str, str]):
        self.path, self.options = path, options

    def send(self, batch: pa.Table) -> None:
        raise NotImplementedError

    def close(self) -> None:
        """After the last batch; a task without a batch never opens a target."""


def too_wide(batch: pa.Table, widths: dict[str, int]) -> str | None:
    """The columns with a value over its VARCHAR width, as a relational target would complain."""
    import pyarrow.compute as pc

    over = [c for c, w in widths.items() if (pc.max(pc.utf8_length(batch.column(c))).as_py() or 0) > w]
    return ",".join(over) or None


class WidthChecked(Target):
    """Refuses a batch with a value that a VARCHAR column of the option ``widths`` can't hold."""

    def __init__(self, path: str, options: dict[str, str]):
        super().__init__(path, options)
        self.widths = json.loads(options.get("widths", "{}"))

    def send(self, batch: pa.Table) -> None:
        over = too_wide(batch, self.widths)
        if over:
            raise Refused(over)
        self.put(batch)

    def put(self, batch: pa.Table) -> None:
        raise NotImplementedError


class ParquetTarget(WidthChecked):
    """One Parquet file for each task, one row group for each batch."""

    suffix = ".parquet"
    writer = None

    def put(self, batch: pa.Table) -> None:
        import pyarrow.parquet as pq

        if self.writer is None:
            self.out = fs.open_output(self.path + self.suffix)
            self.writer = pq.ParquetWriter(self.out, batch.schema)
        self.writer.write_table(batch, row_group_size=max(1, batch.num_rows))

    def close(self) -> None:
        if self.writer is not None:
            self.writer.close()
            self.out.close()


class CopyTextTarget(WidthChecked):
    """Load-ready text (S10), one file for each task. The lines come made, in the column ``value``; no other is written."""

    suffix = ".txt"
    out = None

    def put(self, batch: pa.Table) -> None:
        if self.out is None:
            self.out = fs.open_output(self.path + self.suffix)
        lines = batch.column("value").to_pylist()
        self.out.write("".join(f"{line}\n" for line in lines).encode())

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


@dataclass
class TaskDone(WriterCommitMessage):
    name: str | None  # of the task's files; None if it had no rows
    sent: int = 0
    failed: int = 0
    written: int = 0
    refused: int = 0


def _runs(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of each run of equal values."""
    import numpy as np

    values = np.asarray(column)
    begins = np.flatnonzero(np.diff(values, prepend=values[:1] - 1)).tolist()
    yield from ((int(values[a]), a, b) for a, b in zip(begins, [*begins[1:], len(values)], strict=True))


class BatchWriter(DataSourceArrowWriter):
    """Rows in the order of their batch number; a batch's rows are all in one task."""

    def __init__(self, options: dict[str, str], target: type[Target]):
        self.path, self.load, self.by = options["path"], options["load"], options["batch_column"]
        self.options, self.target = dict(options), target

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskDone:
        name, done, held, number = uuid.uuid4().hex, TaskDone(None), [], None
        self.out, self.refused, self.report = None, None, []
        for rows in iterator:
            for value, a, b in _runs(rows.column(self.by)) if rows.num_rows else ():
                if held and value != number:
                    self._deliver(name, number, pa.Table.from_batches(held), done)
                    held = []
                number = value
                held.append(rows.slice(a, b - a))
        if held:
            self._deliver(name, number, pa.Table.from_batches(held), done)
        if self.out is not None:
            self.out.close()
        if self.refused is not None:
            self.refused.close()
        if self.report:
            import pyarrow.parquet as pq

            done.name = name
            with fs.open_output(f"{self.path}/report/{name}.parquet") as out:
                pq.write_table(pa.Table.from_pylist(self.report, REPORT), out)
        return done

    def _deliver(self, name: str, number: int, batch: pa.Table, done: TaskDone) -> None:
        error, n = None, batch.num_rows
        if self.out is None:
            self.out = self.target(f"{self.path}/data/{name}", self.options)
        try:
            self.out.send(batch.drop_columns([self.by]))
            done.sent += 1
            done.written += n
        except Refused as e:
            error = str(e)
            done.failed += 1
            done.refused += n
            if self.refused is None:  # whatever the target is, refused rows are kept as Parquet
                self.refused = ParquetTarget(f"{self.path}/refused/{name}", {})
            self.refused.put(batch)
        self.report.append({"batch": number, "rows": n, "sent": error is None, "error": error})

    def commit(self, messages: list[TaskDone | None]) -> None:
        """One small file for the whole write, with a line for each task; it makes the write visible."""
        lines = [json.dumps(vars(m)) for m in messages if m is not None and m.name is not None]
        fs.write_bytes(f"{self.path}/commits/{self.load}.json", "\n".join(lines).encode())

    def abort(self, messages: list[TaskDone | None]) -> None:
        """Files of a write that failed have no commit that names them; nobody reads them."""


def sink_source(target: type[Target]) -> type[DataSource]:
    """The Spark data source that writes to a target, under the name ``sink_<class name>``."""

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"sink_{target.__name__.lower()}"

        def writer(self, schema, overwrite: bool) -> BatchWriter:
            return BatchWriter(dict(self.options), target)

    return Sink


def send_batches(
    records: DataFrame,
    path: str,
    target: type[Target] = ParquetTarget,
    size: int = 100_000,
    order_by: Sequence[str] = (),
    widths: dict[str, int] | None = None,
    load: str | None = None,
) -> None:
    """``records`` to a sink in batches of ``size``, each whole or not at all. Several sends may share ``path``.

    ``widths``: VARCHAR widths that the targets of this module hold the batches to. A batch under ``size`` rows is
    the last. ``load`` names the write: sent again under its name, it replaces what it sent before.
    """
    spark = records.sparkSession
    ship_package(spark)
    spark.dataSource.register(sink_source(target))
    batches = with_chunks(records, size, order_by, "_batch").repartition("_batch").sortWithinPartitions("_batch", *order_by)
    writer = batches.write.format(f"sink_{target.__name__.lower()}").mode("append")
    writer.options(load=load or uuid.uuid4().hex, batch_column="_batch", widths=json.dumps(widths or {})).option("path", path).save()


COMMIT_DDL = "name string, sent bigint, failed bigint, written bigint, refused bigint"


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """A row for each task that had rows, over all committed writes."""
    return spark.read.schema(COMMIT_DDL).json(f"{path}/commits")


def sink_counters(spark: SparkSession, path: str) -> DataFrame:
    """M1 of a sink: ``batches_sent, batches_failed, records_written, records_refused`` of the committed writes."""
    names = {"batches_sent": "sent", "batches_failed": "failed", "records_written": "written", "records_refused": "refused"}
    return _committed(spark, path).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in names.items()))


def _files(spark: SparkSession, path: str, folder: str, suffix: str, having: str) -> list[str]:
    """Files of committed tasks; names only, one for each task, as Spark's own file listing has them."""
    rows = _committed(spark, path).where(having).select("name").collect()
    return [f"{path}/{folder}/{r.name}{suffix}" for r in rows]


def read_sink(spark: SparkSession, path: str, schema: str, refused: bool = False) -> DataFrame:
    """What a Parquet sink holds, or the rows of the batches it refused, with their ``_batch`` if the schema has it."""
    folder, having = ("refused", "refused > 0") if refused else ("data", "written > 0")
    files = _files(spark, path, folder, ".parquet", having)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read_copy_sink(spark: SparkSession, path: str) -> DataFrame:
    """The lines that a load-ready text sink holds."""
    files = _files(spark, path, "data", ".txt", "written > 0")
    return spark.read.option("lineSep", "\n").text(files) if files else spark.createDataFrame([], "value string")


def batch_report(spark: SparkSession, path: str) -> DataFrame:
    """``batch, rows, sent, error`` of each batch of the committed writes; ``error`` says why it was refused."""
    files = _files(spark, path, "report", ".parquet", "sent + failed > 0")
    return spark.read.schema(REPORT_DDL).parquet(*files) if files else spark.createDataFrame([], REPORT_DDL)


def varchar_widths(layout: Layout = EMPRESAS) -> dict[str, int]:
    return {f.name: f.width for f in layout.fields if f.width}
