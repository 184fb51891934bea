"""Spark sessions for local runs, and the folder that driver and executors share."""

from __future__ import annotations

import itertools
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_counter = itertools.count()
_open = threading.local()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The bytes of rows that go to Python at once, and the rows that a scan holds as columns.
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20), "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings one."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weftline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where none is set and all runs on this machine, as in tests, one of our own."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = sc._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-"))
        found = sc._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``written`` inside go at the end, but for those to ``keep``, which the scratch around it takes over if there is one."""
    outer = getattr(_open, "around", None), getattr(_open, "paths", None)
    _open.around, _open.paths = outer[1], []
    try:
        yield
    finally:
        paths = _open.paths
        _open.around, _open.paths = outer
        for path in paths:
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def written(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    This cuts the lineage in a way that survives the loss of any executor. The
    table goes when the driver's JVM ends, or with the ``scratch`` it is written
    in. The shuffle files of the write go with it: nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftline-{label}-{next(_counter)}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    owner = getattr(_open, "around" if keep else "paths", None)
    if owner is not None:
        owner.append(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on batches of rows for Python hold about 1 MB, and batches of a scan 1024 rows, unless the session has bounds of its own.

    Spark's hold 10,000 rows up to 64 MB, outside the heap and in buffers that
    double as they grow, and 4096. The bounds stay, since frames are planned
    when they are run; no result depends on them.
    """
    own = spark.conf.getAll
    for key, value in _BATCHES.items():
        if key not in own:
            spark.conf.set(key, value)


def table_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``: an upper bound for plain scans."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, each: int = 4 << 20) -> DataFrame:
    """A table of less than ``each`` bytes a core dealt out over all cores; a larger one as it is.

    A scan gives a row group to one task, so a small file with one group would
    keep one core busy. A table of many groups is never moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if table_bytes(df) < each * cores else df


def pieces(df: DataFrame, each: int = 8 << 20) -> int:
    """How many parts to deal the rows of ``df`` out in, so that one has about ``each`` bytes of its tables as stored, and no fewer than shuffles have.

    Adaptive execution puts parts together up to a size as shuffled, and sorts and
    maps of narrow rows take twenty times that; a number of parts it leaves alone.
    What has no stored size, as rows of the driver, does not count.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(width(df.sparkSession), -(-sum(x for x in sizes if x < 1 << 50) // each))


def width(spark: SparkSession) -> int:
    """The number of partitions that shuffles are set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
