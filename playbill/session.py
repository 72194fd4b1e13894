"""Session settings and the folder for intermediate tables."""

import atexit
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SHUFFLE_BYTES = 128 * 1024 * 1024
#: What a task of a write reads and sorts at most. Rows take some ten times as much in memory as
#: in compressed files and shuffles, so Spark's own sizes (128 and 64 MB) are over a GB of a sort.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 * 1024 * 1024,
}
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_UNITS = {"": 0, "b": 0, "k": 1, "kb": 1, "m": 2, "mb": 2, "g": 3, "gb": 3, "t": 4, "tb": 4}


def build_session(app: str = "playbill", **settings: str) -> SparkSession:
    """A session with the settings the jobs are laid out for; ``settings`` override them."""
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.session.timeZone": "UTC",
    }
    builder = SparkSession.builder.appName(app)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, *paths: str, factor: int = 1) -> int:
    """Set the number of shuffle partitions from the size of the input files times ``factor``.

    Adaptive execution merges small partitions but cannot split those of an aggregation, so a
    large input needs enough of them from the start. Only file sizes are read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    sizes = files.load(list(paths)).agg(F.sum("length")).first()[0] or 0
    sizes *= factor
    parallelism = spark.sparkContext.defaultParallelism
    count = max(parallelism, -(-sizes // SHUFFLE_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def _in_bytes(size: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", size).groups()
    return int(number) * 1024 ** _UNITS[unit.lower()]


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is started within go as soon as it has ended.

    Spark keeps them until the driver's memory is next collected, so that those of each step of a
    job would add up on the disks. Frames made within have this setting wherever they run.
    """
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """Writes within it have tasks of ``TASK_BYTES`` at most; smaller settings of a session stay.

    Tasks sort their rows. By Spark's own sizes a task grows with the table until it takes
    more memory than its share of an executor, and spills. Only what runs within is bounded, and
    leaves no shuffle files.
    """
    before = {name: spark.conf.get(name) for name in TASK_BYTES}
    try:
        for name, most in TASK_BYTES.items():
            if _in_bytes(before[name]) > most:
                spark.conf.set(name, str(most))
        with released_shuffles(spark):
            yield
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, for this application's intermediate tables.

    It lies in ``spark.checkpoint.dir``, or in the warehouse folder where that is unset: both
    are shared by the driver and all executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/playbill/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table in the shared folder."""
    folder = shared_folder(spark)
    if folder not in _cleared_at_exit:
        _cleared_at_exit.add(folder)
        atexit.register(_remove, SparkContext._jvm, folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def clear_intermediates(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; call it before stopping the session."""
    _remove(spark._jvm, shared_folder(spark))


_cleared_at_exit: set[str] = set()


def _remove(jvm, folder):
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # the gateway is gone: the folder stays, named after the application
        return
