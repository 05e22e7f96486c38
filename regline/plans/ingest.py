"""The whole load as one Spark plan per step.

    select files (S3, S8) -> scan (S1 text + S4 zip) -> classify (P2-P6, V1-V4)
      -> stage: key and line of accepted rows, rejected rows with their reason,
         in ONE pass over the input, counters observed (M1)
      -> publish: one line per key (V5), not stored before (V5), split into the
         record's columns, rebalanced by uf, sorted (S12), bounded files (S13),
         written to the load's own folder of the table -> commit with the
         statistics (M1, M2)

The raw input is read exactly once, and the record's columns are encoded
exactly once: what is staged of an accepted row is its key and its line. The
staged Parquet cuts the lineage, so a retry after a lost executor rereads
decoded lines, not archives. It is removed once the table holds the records.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regline.layout import EMPRESAS, Layout, release_files
from regline.operators.keys import KeyIndex
from regline.operators.records import classify
from regline.operators.stats import batches_for, counter_columns, stats_frame, stats_values, with_rates
from regline.plans.sizing import scan_conf, shuffle_conf
from regline.session import staged
from regline.sinks.commits import Commits
from regline.sinks.tables import read_partitioned, table_schema, write_partitioned
from regline.sources import fs
from regline.sources.archives import lines_of_planned, plan_archives, read_planned_raw
from regline.sources.files import not_yet_ingested
from regline.sources.text import dataset_files, expected_bytes, line_bytes, lines_from_raw, read_raw, short_files

NO_LINES = "file_path string, file_name string, line string"


@dataclass
class Inputs:
    files: list  # rows (path, file_name, length, modification_time) of the chosen files
    missing: tuple[str, ...] = ()  # wanted names that are not there (S2)
    left_out: tuple[str, ...] = ()  # .csv and .zip files that were not asked for
    taken_before: tuple[str, ...] = ()  # chosen files that the ledger holds

    @property
    def text(self) -> list:
        return [f for f in self.files if f.file_name.endswith(".csv")]

    @property
    def zips(self) -> list:
        return [f for f in self.files if f.file_name.endswith(".zip")]


def resolve_inputs(
    spark: SparkSession,
    root: str,
    families: tuple[str, ...] | None = ("Empresas",),
    names: list[str] | None = None,
    ledger: DataFrame | None = None,
    complete: bool = False,
) -> Inputs:
    """S3 + S4 + S8: the selected ``.csv`` and ``.zip`` files, minus files already ingested.

    ``complete``: files that a complete release has of these families and this
    folder has not, plain or zipped, count as missing. Only file metadata is handled here (as Spark's own file listing does).
    """
    listing = dataset_files(spark, root, families=families, names=names)
    rows = sorted((r for r in listing.collect() if r.file_name.endswith((".csv", ".zip"))), key=lambda r: r.path)
    present = {r.file_name for r in rows}
    chosen = [r for r in rows if r.selected]
    stems = {r.file_name.rsplit(".", 1)[0] for r in rows}
    absent = [f"{stem}.zip" for stem in (release_files(families) if complete else ()) if stem not in stems]
    new = {r.path for r in chosen}
    if ledger is not None and chosen:
        new = {r.path for r in not_yet_ingested(listing.where("selected"), ledger).select("path").collect()}
    return Inputs(
        [r for r in chosen if r.path in new],
        tuple(sorted([n for n in (names or ()) if n not in present] + absent)),
        tuple(r.file_name for r in rows if not r.selected),
        tuple(r.file_name for r in chosen if r.path not in new),
    )


@contextmanager
def sql_conf(spark: SparkSession, **settings):
    """Set SQL settings for one step and restore them afterwards."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@dataclass
class Release:
    """The lines of the chosen files, and what is known of the files before reading them."""

    lines: DataFrame
    input_bytes: int  # unpacked
    not_archives: list[str] = field(default_factory=list)
    too_large: list[str] = field(default_factory=list)
    damaged: Observation | None = None  # gets ``archives``: those of which a member could not be read to its end
    unopened: list[str] = field(default_factory=list)  # plain files
    text_bytes: dict = field(default_factory=dict)  # plain file -> bytes of its lines, if read to its end
    text_read: Observation | None = None  # gets ``bytes``, of the lines of all plain files

    def unread(self, spark: SparkSession) -> set[str]:
        """Files that could not be read to their end, after the pass over the lines."""
        found = self.damaged.get["archives"] if self.damaged else []
        short = []
        if self.text_read and self.text_read.get["bytes"] != sum(self.text_bytes.values()):
            short = short_files(spark, self.text_bytes)
            if not short:
                raise RuntimeError("lines of a plain file were lost to an error that has passed; run the load again")
        return {*self.not_archives, *self.too_large, *found, *self.unopened, *short}


def open_release(
    spark: SparkSession, inputs: Inputs, encoding: str = "ISO-8859-1", max_total_bytes: int | None = None
) -> Release:
    """Plain files and archives together. Central directories are read once, by executors.

    A plain file that cannot be read ends where reading fails, as a member of
    an archive does; the bytes of all lines, summed in the same pass, tell
    whether there was one.

    ``max_total_bytes``: archives that unpack to more are left out and counted
    as failed; without it none is.
    """
    parts, size = [], sum(f.length for f in inputs.text)
    out = Release(spark.createDataFrame([], NO_LINES), size)
    if inputs.text:
        expected = expected_bytes(inputs.text)
        out.unopened = [path for path, n in expected.items() if n is None]
        out.text_bytes = {path: n for path, n in expected.items() if n is not None}
    if out.text_bytes:
        out.text_read = Observation()  # unnamed: lines of several releases may meet in one plan
        raw = read_raw(spark, list(out.text_bytes), tolerant=True)
        parts.append(lines_from_raw(raw.observe(out.text_read, line_bytes().alias("bytes")), encoding))
    if inputs.zips:
        plan = plan_archives(spark, [f.path for f in inputs.zips], max_total_bytes)
        out.not_archives = [a for a, v in plan.verdicts.items() if v == "not_zip"]
        out.too_large = [a for a, v in plan.verdicts.items() if v == "oversize"]
        out.input_bytes += plan.member_bytes
        if plan.partitions:
            out.damaged = Observation()
            unread = F.when(F.col("value").isNull(), F.substring_index("file_path", "#", 1))
            raw = read_planned_raw(spark, plan).observe(out.damaged, F.collect_set(unread).alias("archives"))
            parts.append(lines_of_planned(raw, encoding))
    for part in parts:
        out.lines = part if part is parts[0] else out.lines.unionByName(part)
    return out


def read_release(spark: SparkSession, inputs: Inputs, encoding: str = "ISO-8859-1") -> DataFrame:
    return open_release(spark, inputs, encoding).lines


def staged_frame(classified: DataFrame, layout: Layout = EMPRESAS) -> DataFrame:
    """What later steps need of each line: the key of an accepted one, the reason of a rejected one."""
    ok = F.col("reason").isNull()
    return classified.select(
        F.when(ok, F.lit("accepted")).otherwise(F.lit("rejected")).alias("outcome"),
        "file_path",
        "file_name",
        "line",
        F.when(ok, F.col(layout.key)).alias(layout.key),
        "n_fields",
        "reason",
        "detail",
    )


def staged_schema(layout: Layout = EMPRESAS) -> str:
    return (
        f"file_path string, file_name string, line string, `{layout.key}` string, n_fields int, reason string, "
        "detail string, outcome string"
    )


def read_staged(spark: SparkSession, path: str, outcome: str, layout: Layout = EMPRESAS) -> DataFrame:
    """With its schema stated, so an outcome that no line had reads as no rows."""
    rows = spark.read.schema(staged_schema(layout)).option("basePath", path).parquet(path)
    return rows.where(F.col("outcome") == outcome)


def unique_lines(lines: DataFrame, key: str) -> tuple[DataFrame, int]:
    """V5 on staged lines: one line per key, the smallest by file path and line; how many others there are.

    A key-only hash aggregate finds the keys held more than once; lines of all
    other keys pass through. Only lines of repeated keys go through
    ``min(struct)``, whose partial sums fold a hot key before the shuffle.
    """
    repeated = staged(
        lines.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(key).alias("r_key"), "n"), "repeated-keys"
    )
    extra = repeated.agg(F.sum(F.col("n") - 1)).first()[0] or 0
    if not extra:  # the usual case for a clean release: nothing to join
        return lines.select(key, "file_path", "line"), 0
    same = F.col(key).eqNullSafe(F.col("r_key"))  # a null key is one group too
    once = lines.join(repeated, same, "left_anti").select(key, "file_path", "line")
    first = lines.join(repeated, same, "left_semi").groupBy(key).agg(F.min(F.struct("file_path", "line")).alias("first"))
    return once.unionByName(first.select(key, "first.*")), int(extra)


def records_of(lines: DataFrame, layout: Layout = EMPRESAS, trim: bool = False) -> DataFrame:
    """Accepted lines -> the record's columns."""
    named = lines.select("file_path", F.lit(None).cast("string").alias("file_name"), "line")
    return classify(named, layout, trim=trim, check_widths=False).select(*layout.names)


@dataclass
class IngestResult:
    stats: DataFrame
    table_path: str
    staging_path: str
    elapsed_secs: float
    steps: dict | None = None  # seconds per step: resolve, stage, keys, publish

    def table(self, spark: SparkSession, layout: Layout = EMPRESAS) -> DataFrame:
        return read_partitioned(spark, self.table_path, layout)

    def quarantine(self, spark: SparkSession, layout: Layout = EMPRESAS) -> DataFrame:
        """This load's rejected lines; none after a clean load."""
        return read_staged(spark, self.staging_path, "rejected", layout).select(
            "file_path", "file_name", "line", "n_fields", "reason", "detail"
        )


def ingest(
    spark: SparkSession,
    root: str,
    target: str,
    layout: Layout = EMPRESAS,
    families: tuple[str, ...] | None = ("Empresas",),
    names: list[str] | None = None,
    ledger: DataFrame | None = None,
    trim: bool = False,
    deduplicate: bool = True,
    batch_size: int = 100_000,
    max_records_per_file: int | None = None,
    record_filter: str | None = None,
    ledger_path: str | None = None,
    max_total_bytes: int | None = None,
    complete: bool = False,
) -> IngestResult:
    """Load one release folder into ``target``: its table/, to which every load
    and every stream adds a commit, and a folder of rejected lines per load below loads/.

    Plain files and archives of the release are both read. ``deduplicate``
    keeps one record per key over this load and all loads before it, whose keys
    are looked up in the index in keys/ (``operators.keys``). A load that failed
    is not seen in the table and may simply be run again. ``complete`` counts
    parts of the release that are not there as failed files.

    ``ledger_path``: a Parquet table of files already taken (path, name,
    length, modification time). Files in it are skipped (S8), and those that
    this load has read to their end are appended to it once the load has
    succeeded, so repeated runs over a growing folder (plain or ZIP) take only
    new files (R1 in batch form), and files that could not be read are tried
    again.
    """
    started = time.perf_counter()
    if ledger_path is not None and ledger is None:
        ledger = read_ledger(spark, ledger_path)
    inputs = resolve_inputs(spark, root, families, names, ledger, complete)
    result, read = load_inputs(
        spark, inputs, target, new_load_id(), layout, trim=trim, deduplicate=deduplicate, batch_size=batch_size,
        max_records_per_file=max_records_per_file, record_filter=record_filter, max_total_bytes=max_total_bytes, started=started,
    )
    if ledger_path is not None and read:
        spark.createDataFrame(
            [(f.path, f.file_name, f.length, f.modification_time, target) for f in read], LEDGER_SCHEMA
        ).write.mode("append").parquet(ledger_path)
    return result


def new_load_id() -> str:
    return f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"


def load_inputs(
    spark: SparkSession,
    inputs: Inputs,
    target: str,
    load_id: str,
    layout: Layout = EMPRESAS,
    trim: bool = False,
    deduplicate: bool = True,
    against_stored: bool = True,
    batch_size: int = 100_000,
    max_records_per_file: int | None = None,
    record_filter: str | None = None,
    max_total_bytes: int | None = None,
    started: float | None = None,
) -> tuple[IngestResult, list]:
    """Load the chosen files as one commit of the table; the result, and the files read to their end.

    Batch loads and the micro-batches of a stream both come through here.
    ``against_stored``: with ``deduplicate``, keys of earlier loads count too.
    """
    started = time.perf_counter() if started is None else started
    steps: dict[str, float] = {}

    def lap(step: str) -> None:
        steps[step] = time.perf_counter() - started - sum(steps.values())

    table_path = f"{target}/table"
    commits = Commits(table_path)
    name = commits.begin(load_id)
    release = open_release(spark, inputs, max_total_bytes=max_total_bytes)
    cores = spark.sparkContext.defaultParallelism
    lap("resolve")

    # Pass 1: the only read of the raw input.
    staged_obs = Observation("staged")
    passes = F.expr(record_filter) if record_filter else F.lit(True)
    wanted = F.col("reason").isNull() & passes
    classified = classify(release.lines, layout, trim=trim).observe(
        staged_obs, *counter_columns(), F.count_if(wanted).alias("records_wanted")
    )
    load = f"{target}/loads/{load_id}"
    stage_conf = {"spark.sql.maxConcurrentOutputFileWriters": "4", **scan_conf(release.input_bytes, cores)}
    with sql_conf(spark, **stage_conf):  # read when the write plans its scan
        rows = staged_frame(classified.where(F.col("reason").isNotNull() | wanted), layout)
        writer = rows.write.mode("overwrite").options(**layout.parquet_options(extra=("line",)))
        writer.partitionBy("outcome").parquet(load)  # a load tried again replaces what it staged
    counters = staged_obs.get
    accepted, kept = int(counters["records_processed"]), int(counters["records_wanted"])
    unread = release.unread(spark)
    lap("stage")

    # Pass 2: staged lines -> one per key, not stored yet -> table layout.
    publish_conf = shuffle_conf(release.input_bytes, cores)
    written, repeated = 0, 0
    if kept:
        with sql_conf(spark, **publish_conf):
            lines = read_staged(spark, load, "accepted", layout)
            if deduplicate:
                lines, repeated = unique_lines(lines, layout.key)
                if against_stored and commits.names():
                    index = KeyIndex(spark, f"{target}/keys", table_path, layout)
                    index.catch_up()
                    lines = index.unseen(lines)
            lap("keys")
            written_obs = Observation("written")
            write_partitioned(
                records_of(lines, layout, trim), commits.folder(name), layout, max_records_per_file, observation=written_obs
            )
            written = int(written_obs.get["n"])
    else:
        write_partitioned(spark.createDataFrame([], table_schema(layout)), commits.folder(name), layout)
    lap("publish")
    elapsed = time.perf_counter() - started

    read = [f for f in inputs.files if f.path not in unread]
    values = dict(counters)
    values.update(
        records_written=written,
        records_filtered=accepted - kept,
        duplicates_dropped=repeated,
        already_stored=kept - repeated - written,
        files_read=len(read),
        files_failed=len(inputs.missing) + len(unread),
        files_left_out=len(inputs.left_out),
        bytes_read=release.input_bytes,
        batches_sent=batches_for(kept, batch_size),
    )
    stats = stats_values(values)
    commits.commit(name, stats)
    fs.delete_dir(f"{load}/outcome=accepted")  # the table holds these now
    return IngestResult(with_rates(stats_frame(spark, stats), elapsed), table_path, load, elapsed, steps), read


LEDGER_SCHEMA = "path string, file_name string, length bigint, modification_time timestamp, loaded_into string"


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Files already ingested; empty when the ledger does not exist yet."""
    if not fs.exists(ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
