"""Monthly releases: differences (D8) and applying them."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.layout import EMPRESAS, Layout
from regline.session import fresh_dir, staged
from regline.sinks.commits import Commits
from regline.sinks.tables import read_partitioned, write_partitioned
from regline.sources import fs

CHANGES = ("inserted", "deleted", "updated", "unchanged")


def release_diff(old: DataFrame, new: DataFrame, layout: Layout = EMPRESAS) -> DataFrame:
    """(key, change, new record columns) for the union of both keys.

    One full outer join on the key; all other columns compared null-safe.
    Both sides must hold one row per key (see ``repeated_keys``), so that the
    join cannot multiply rows.
    """
    key = layout.key
    rest = [c for c in layout.names if c != key]
    o = old.select(key, F.lit(True).alias("_in_old"), *[F.col(c).alias(f"_old_{c}") for c in rest])
    n = new.select(key, F.lit(True).alias("_in_new"), *rest)
    j = o.join(n, key, "full")
    same = reduce(lambda a, b: a & b, [F.col(f"_old_{c}").eqNullSafe(F.col(c)) for c in rest])
    change = (
        F.when(F.col("_in_old").isNull(), F.lit("inserted"))
        .when(F.col("_in_new").isNull(), F.lit("deleted"))
        .when(same, F.lit("unchanged"))
        .otherwise(F.lit("updated"))
    )
    return j.select(key, change.alias("change"), *rest)


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change").agg(F.count(F.lit(1)).alias("records"))


def changes(diff: DataFrame) -> DataFrame:
    """D8 -> D9: only the rows that change the snapshot (what a monthly
    difference file holds)."""
    return diff.where(F.col("change") != "unchanged")


def repeated_keys(release: DataFrame, layout: Layout = EMPRESAS) -> DataFrame:
    """Keys that a release holds more than once; a diff needs there to be none."""
    return release.groupBy(layout.key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def apply_diff(stored: DataFrame, changed: DataFrame, layout: Layout = EMPRESAS) -> DataFrame:
    """Stored snapshot + change rows -> new snapshot (kept ∪ inserted ∪ updated).

    The keys to drop (deleted and updated) are staged, so the planner knows
    their bytes: a small change set is broadcast and the stored snapshot
    streams through an anti join with no shuffle; a large one is shuffled.
    Write the result to a NEW folder; never overwrite the one being read.
    """
    key = layout.key
    gone = staged(changed.where(F.col("change").isin("deleted", "updated")).select(key), "changed-keys")
    kept = stored.select(*layout.names).join(gone, key, "left_anti")
    fresh = changed.where(F.col("change").isin("inserted", "updated")).select(*layout.names)
    return kept.unionByName(fresh)


def apply_in_place(spark: SparkSession, path: str, changed: DataFrame, layout: Layout = EMPRESAS) -> list[str | None]:
    """D9 on a snapshot written by ``write_partitioned``: only the partitions that a change touches are written again.

    Touched are the partitions that hold a changed key now and those it goes
    to; the others keep their files. Finding the first kind reads two columns
    of the snapshot. The new rows of touched partitions are written aside,
    then take their places by dynamic partition overwrite, and a partition
    left without rows is removed. That is not one step for readers: a run that
    failed is simply run again, with the same result. Returns the touched
    partition values.
    """
    if Commits(path).kept:
        raise ValueError(f"{path} is a table of committed loads, not a snapshot")
    if len(layout.partition_by) != 1:
        raise ValueError("partial apply needs a layout with one partition column")
    key, part = layout.key, layout.partition_by[0]
    stored = read_partitioned(spark, path, layout)
    # All changed keys go, inserted ones too: a second run finds them stored.
    keys = staged(changed.where(F.col("change") != "unchanged").select(key).distinct(), "changed-keys")
    fresh = changed.where(F.col("change").isin("inserted", "updated")).select(*layout.names)
    held = stored.select(key, part).join(keys, key, "left_semi").select(part)
    touched = [row[0] for row in held.unionByName(fresh.select(part)).distinct().collect()]  # partition values
    if not touched:
        return []
    in_touched = F.col(part).isin([v for v in touched if v is not None])
    if None in touched:
        in_touched = in_touched | F.col(part).isNull()
    kept = stored.where(in_touched).join(keys, key, "left_anti")
    aside = fresh_dir(spark, "partial-apply")
    write_partitioned(kept.unionByName(fresh), aside, layout)
    write_partitioned(read_partitioned(spark, aside, layout), path, layout, mode="overwrite", only_partitions=True)
    left = {_value(folder) for folder in fs.subfolders(aside)}
    for folder in fs.subfolders(path):
        if _value(folder) in set(touched) - left:
            fs.delete_dir(folder)
    fs.delete_dir(aside)
    spark.catalog.refreshByPath(path)
    return sorted(touched, key=lambda v: (v is None, v))


def _value(folder: str) -> str | None:
    """The partition value that a folder's name states, as Spark writes it."""
    value = unquote(folder.rstrip("/").rsplit("/", 1)[-1].split("=", 1)[-1])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value
