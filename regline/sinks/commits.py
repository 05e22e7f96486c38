"""Loads of one table that appear whole or not at all.

Each load, a batch load or a micro-batch of a stream, writes its records below
a folder of its own, ``load=<name>/uf=<value>/``, and then a commit: a small
file in ``_commits/`` of the same name with the load's counters. Readers and
the key index take the folders that have a commit, so a load that failed
half-way is not seen, and batch and stream share one table.

A load's id may be tried several times, each try in a folder of its own. Whoever
runs loads asks ``committed`` first, so one that is replayed adds nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from regline.sources import fs

FOLDER = "load="


class Commits:
    """The commits of the table at ``table``."""

    def __init__(self, table: str):
        self.table = table.rstrip("/")
        self.home = f"{self.table}/_commits"

    @property
    def kept(self) -> bool:
        """Whether the table is one of committed loads; a plain Parquet folder is not."""
        return fs.exists(self.home)

    def names(self) -> list[str]:
        """Names of the committed tries, one listing."""
        return sorted(name[: -len(".json")] for _, name, *_ in fs.list_dir(self.home) if name.endswith(".json"))

    def committed(self, load: str) -> bool:
        return any(name.rsplit("-", 1)[0] == load for name in self.names())

    def folder(self, name: str) -> str:
        return f"{self.table}/{FOLDER}{name}"

    def folders(self) -> list[str]:
        return [self.folder(name) for name in self.names()]

    def data_files(self) -> list[str]:
        """Parquet files of the committed loads, or of the whole folder where loads are not committed."""
        there = [uri for uri, name, *_ in fs.list_dir(self.table, recursive=True) if name.endswith(".parquet")]
        if not self.kept:
            return there
        names = set(self.names())
        return [uri for uri in there if uri.rsplit(f"/{FOLDER}", 1)[-1].split("/", 1)[0] in names]

    def begin(self, load: str) -> str:
        """A name for this try of ``load``. What earlier tries of it left uncommitted is removed."""
        if not self.kept:
            if fs.exists(self.table) and self.data_files():
                raise ValueError(f"{self.table} holds Parquet files that no commit names; load into a new target")
            # Its being there tells readers that only committed folders count.
            fs.write_bytes(f"{self.home}/README", b"A load counts when a file here has its folder's name.\n")
        names = set(self.names())
        for folder in fs.subfolders(self.table):
            name = folder.rsplit("/", 1)[-1].removeprefix(FOLDER)
            if name.rsplit("-", 1)[0] == load and name not in names:
                fs.delete_dir(folder)
        return f"{load}-{uuid.uuid4().hex[:8]}"

    def commit(self, name: str, counters: dict) -> None:
        """Make the written folder of ``name`` part of the table, in one step."""
        entry = {"load": name.rsplit("-", 1)[0], **counters}
        fs.write_whole(f"{self.home}/{name}.json", json.dumps(entry).encode())

    def counters(self, spark: SparkSession, schema: str) -> DataFrame:
        """One row for each committed load: its id and its counters."""
        files = [f"{self.home}/{name}.json" for name in self.names()]
        if not files:
            return spark.createDataFrame([], f"load string, {schema}")
        return spark.read.schema(f"load string, {schema}").json(files)

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        """The records of the committed loads, with the name of their try in ``load``."""
        folders = self.folders()
        full = f"{schema}, load string"
        if not folders:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", self.table).parquet(*folders)
