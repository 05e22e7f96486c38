"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Partition counts are left to AQE, which
# coalesces small shuffles and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Partition directory values such as uf=01 must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Snapshots hold one sorted file per bucket; joins on the key then need no sort.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The parse stage (one line -> 22 checked columns) generates one large
    # method; HotSpot by default never JIT-compiles methods over 8000 bytes
    # of bytecode and would interpret it, which measured 2-3x slower.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName("regline")
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint directory.

    On a cluster this is the shared folder named in ``spark.checkpoint.dir``.
    Only when the session has none (local tests) a fresh local folder is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder every executor can reach (e.g. on the cluster's shared "
                "storage); a driver-local folder would be invisible to executors"
            )
        base = configured or tempfile.mkdtemp(prefix="regline-ckpt-")
        sc.setCheckpointDir(base)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder (not created)."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and
    its size is known to the planner, which broadcasts it only if it is small."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (once per session).

    The package is zipped into the shared folder and registered with
    ``addPyFile``, the standard way to distribute code to executors.
    """
    import hashlib
    import io
    import zipfile

    key = spark.sparkContext.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in sorted(os.walk(pkg_dir)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    rel = os.path.relpath(full, os.path.dirname(pkg_dir))
                    zf.write(full, rel)
    data = buf.getvalue()
    from regline.sources import fs

    target = f"{shared_dir(spark)}/regline-code/regline-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    if not fs.exists(target):
        fs.write_bytes(target, data)
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(key)
