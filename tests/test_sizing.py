"""Partition sizing from input size (no Spark needed)."""

from regline.plans.sizing import MAX_SPLIT, MIB, MIN_SPLIT, scan_conf, shuffle_conf

TB = 1024**4


def test_hundred_terabytes_on_a_thousand_executors():
    cores = 1000 * 8
    split = int(scan_conf(100 * TB, cores)["spark.sql.files.maxPartitionBytes"])
    assert split == MAX_SPLIT  # ~205k scan tasks of 512 MiB, not 800k of 128 MiB
    conf = shuffle_conf(100 * TB, cores)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert 100_000 < parts < 200_000  # ~256 MiB of staged records each
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * MIB)
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == MAX_SPLIT  # 35 TB staged / 16k > 512 MiB


def test_small_input_keeps_every_core_busy():
    assert int(scan_conf(80 * MIB, 8)["spark.sql.files.maxPartitionBytes"]) == MIN_SPLIT
    conf = shuffle_conf(80 * MIB, 8)
    assert conf == {"spark.sql.shuffle.partitions": "16", "spark.sql.files.maxPartitionBytes": str(MIN_SPLIT)}
