"""Spark session helpers.

The library never builds its own cluster configuration beyond what a user
would put in ``spark-defaults.conf``: adaptive execution, UTC session time,
and a shared checkpoint directory read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Settings every job in this package relies on. Shuffle partitions are left to
# the caller (cluster: thousands; tests: a handful) and AQE coalesces them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Wide cleaning projections generate methods above HotSpot's 8 KB JIT
    # limit; without this flag they would run interpreted.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "postolake",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench; clusters pass their own builder."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("POSTOLAKE_DRIVER_MEMORY", "16g"))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    filesystem). Only a local-mode session without that setting gets a fresh
    temporary directory, which is what tests need.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="postolake-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder so "
            "lineage can be cut reliably"
        )
    return sc.getCheckpointDir()


_WORK = "postolake-tables"
_registered: set[str] = set()


def shared_work_dir(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables, inside the checkpoint root.

    The folders of an application are removed when its Python process ends
    normally, or by ``remove_work_dirs``.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if root not in _registered:
        _registered.add(root)
        atexit.register(remove_work_dirs, spark)
    return f"{root}/{_WORK}/{name}"


def remove_work_dirs(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them are no longer usable."""
    sc = spark.sparkContext
    if sc._jsc is None or sc.getCheckpointDir() is None:
        return  # stopped, or nothing was written
    try:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sc.getCheckpointDir()}/{_WORK}")
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    except Py4JError:
        pass  # the JVM is gone, and with it the means to delete


def scale_conf(input_bytes: int, executor_cores: int, executors: int, task_bytes: int = 512 << 20) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of raw files.

    Scan splits and post-shuffle partitions both target ``task_bytes`` (about
    512 MB: large enough to amortise task overhead, small enough to sort and
    spill within an executor core's share of memory). Shuffle partitions start
    at input / task size, at least three waves of the cluster's cores; AQE then
    coalesces small ones and splits skewed ones.
    """
    cores = max(1, executor_cores * executors)
    partitions = max(3 * cores, -(-input_bytes // task_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(task_bytes // 2),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(task_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def size_tasks(spark: SparkSession) -> None:
    """Settings for wide rows that compress well, where the session has Spark's defaults.

    A scan of 128 MB of such files holds millions of rows and its sort spills.
    Methods beyond the 8,000 bytes that HotSpot compiles would run interpreted;
    with this limit such stages use the split code of single operators instead.
    """
    for key, default, value in (
        ("spark.sql.files.maxPartitionBytes", "134217728b", "16m"),
        ("spark.sql.codegen.hugeMethodLimit", "65535", "8000"),
    ):
        if spark.conf.get(key) == default:
            spark.conf.set(key, value)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` for what is executed inside."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def partitions_for(spark: SparkSession, rows: int, task_rows: int):
    """Shuffles of at most about ``task_rows`` rows a partition; adaptive execution merges what is small."""
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // task_rows))
    return settings(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)})


def freeing_shuffles(spark: SparkSession):
    """Shuffle files go when the execution that wrote them ends, not when the driver collects its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def delete_dir(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``.

    Functions passed to ``mapInArrow`` and pandas UDFs are pickled by module
    name. The package is zipped once per Spark context and handed to Spark
    with ``addPyFile``, so a cluster needs no installation of its own.
    """
    sc = spark.sparkContext
    if getattr(sc, "_postolake_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="postolake-ship-"), "postolake-src.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._postolake_shipped = True
