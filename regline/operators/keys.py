"""An index of the keys that a stored table holds (V5 across loads).

The index is a Parquet table of the key column alone, bucketed and sorted by
key. It covers files of the table: a load, or a micro-batch, first adds the
keys of the files that came since (one sorted file to each bucket), then asks
for its own keys. Nothing is lost between a table's write and the index: files
that the index doesn't list as covered are read the next time, and keys added
twice do no harm.

A load's keys are shuffled to the buckets and sort-merged; the index is
neither shuffled nor is the table read. Few keys are sent as a filter, which
prunes to their buckets, so that the work of a small load stays the same while
the table grows: compaction, which leaves one file in each bucket, sizes the
number of buckets from the keys.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.layout import EMPRESAS, Layout
from regline.session import staged
from regline.sinks.commits import Commits
from regline.sources import fs

#: Keys of a bucket, about, after a compaction.
BUCKET_KEYS = 1 << 20
#: Files of a bucket from which on the index is compacted.
COMPACT_FILES = 8
#: Keys that are sent as a filter. More are joined; the result is the same.
FILTER_KEYS = 1000


class KeyIndex:
    """The index of the table at ``table``, kept in the folder ``home``."""

    def __init__(self, spark: SparkSession, home: str, table: str, layout: Layout = EMPRESAS, buckets: int | None = None):
        self.spark, self.home, self.table, self.key = spark, home.rstrip("/"), table.rstrip("/"), layout.key
        self._open(buckets)

    def _versions(self) -> list[tuple[str, str]]:
        """Descriptions of the index, the newest last. One is written when what it describes is complete."""
        found = fs.list_dir(self.home) if fs.exists(self.home) else []
        return sorted((name, uri) for uri, name, *_ in found if name.startswith("version-"))

    def _open(self, buckets: int | None = None) -> None:
        versions = self._versions()
        if not versions:
            self._describe(f"{self.home}/keys-{uuid.uuid4().hex[:8]}", buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            versions = self._versions()
        with fs.open_input(versions[-1][1]) as stream:
            described = json.loads(stream.read())
        self.location, self.buckets = described["location"], described["buckets"]
        self.name = self._attach(self.location, self.buckets)

    def _describe(self, location: str, buckets: int) -> None:
        number = len(self._versions())
        fs.write_bytes(f"{self.home}/version-{number:06d}.json", json.dumps({"location": location, "buckets": buckets}).encode())

    def _attach(self, location: str, buckets: int) -> str:
        name = f"regline_keys_{uuid.uuid4().hex[:10]}"
        self.spark.sql(
            f"CREATE TABLE {name} (`{self.key}` STRING) USING parquet "
            f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{location}/keys'"
        )
        return name

    def _covered(self) -> DataFrame:
        path = f"{self.location}/covered"
        if not fs.exists(path):
            return self.spark.createDataFrame([], "file string")
        return self.spark.read.schema("file string").parquet(path)

    def keys(self) -> DataFrame:
        """The index's rows: every key of the covered files, some perhaps more than once."""
        return self.spark.table(self.name)

    def catch_up(self, apart_from: str | None = None) -> int:
        """Add the keys of the table's files that are not covered yet; how many files these were.

        Of a table of committed loads, only their files count.

        Files whose path holds ``apart_from`` are left for later. Only file
        names are handled here, as Spark's own listing is.
        """
        there = [uri for uri in Commits(self.table).data_files() if not (apart_from and apart_from in uri)]
        if not there:
            return 0
        listed = self.spark.createDataFrame([(uri,) for uri in there], "file string")
        new = [row.file for row in listed.join(self._covered(), "file", "left_anti").collect()]
        if new:
            keys = self.spark.read.schema(f"`{self.key}` string").parquet(*new)
            self._add(self.name, keys.where(F.col(self.key).isNotNull()), self.buckets)
            self._cover(self.location, new)
            if len(self.keys().inputFiles()) >= COMPACT_FILES * self.buckets:
                self.compact()
        return len(new)

    def _add(self, name: str, keys: DataFrame, buckets: int) -> None:
        keys.repartition(buckets, self.key).write.mode("append").insertInto(name)
        self.spark.catalog.refreshTable(name)

    def _cover(self, location: str, files: list[str]) -> None:
        self.spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.mode("append").parquet(f"{location}/covered")

    def compact(self, bucket_keys: int = BUCKET_KEYS) -> None:
        """Rewrite the index with each key once, one sorted file in a bucket, and the number of buckets that its keys
        ask for. A failure before the new one is described leaves the old one in use."""
        keys = self.keys().distinct()
        buckets = max(1, -(-keys.count() // bucket_keys))
        location = f"{self.home}/keys-{uuid.uuid4().hex[:8]}"
        name = self._attach(location, buckets)
        self._add(name, keys, buckets)
        self._cover(location, [row.file for row in self._covered().collect()])
        self._describe(location, buckets)
        old = self.location
        self.location, self.buckets, self.name = location, buckets, name
        fs.delete_dir(old)

    def found(self, keys: DataFrame) -> DataFrame:
        """Those of some distinct keys, a written table of one column, that the index holds."""
        if keys.count() <= FILTER_KEYS:
            wanted = sorted(row[0] for row in keys.collect() if row[0] is not None)
            return self.keys().where(F.col(self.key).isin(wanted)).distinct()
        return keys.hint("merge").join(self.keys().hint("merge"), self.key, "left_semi")

    def unseen(self, records: DataFrame) -> DataFrame:
        """Records whose key the index doesn't hold. Null keys are in no index and stay."""
        keys = staged(records.select(self.key).distinct(), "new-keys")
        stored = staged(self.found(keys), "stored-keys")
        return records.join(stored, self.key, "left_anti")
