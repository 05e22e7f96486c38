"""Partition sizes derived from the input size, so one plan holds from a
laptop to a thousand executors.

* scan splits: about two tasks per core, each between 16 MiB and 512 MiB of
  text (100 TB on 8,000 cores -> 512 MiB splits, ~200k tasks);
* shuffle partitions of the publish step: the staged records (about a third
  of the raw text) cut into ~256 MiB pieces, never fewer than two per core;
  AQE then coalesces small ones and splits skewed ones;
* advisory size 256 MiB for large inputs, so table files are not tiny.
"""

from __future__ import annotations

MIB = 1024 * 1024
MIN_SPLIT, MAX_SPLIT = 16 * MIB, 512 * MIB
SHUFFLE_TARGET = 256 * MIB
STAGED_FRACTION = 0.35  # columnar staged records vs. raw text, measured ~0.28


def scan_conf(input_bytes: int, cores: int) -> dict[str, str]:
    split = input_bytes // max(1, 2 * cores)
    split = max(MIN_SPLIT, min(MAX_SPLIT, split))
    return {"spark.sql.files.maxPartitionBytes": str(split)}


def shuffle_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Publish step: its scan of the staged Parquet and its shuffles."""
    staged = int(input_bytes * STAGED_FRACTION)
    partitions = max(2 * cores, -(-staged // SHUFFLE_TARGET))
    conf = {"spark.sql.shuffle.partitions": str(partitions), **scan_conf(staged, cores)}
    if staged > 64 * SHUFFLE_TARGET:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(SHUFFLE_TARGET)
    return conf


def buckets_for(input_bytes: int, cores: int) -> int:
    """Buckets of a snapshot: as many as the publish step's partitions, so each holds ~256 MiB."""
    return int(shuffle_conf(input_bytes, cores)["spark.sql.shuffle.partitions"])
