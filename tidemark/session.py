"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings the plans in this package count on. The first five are Spark's defaults,
# spelled out because skew handling and failing casts depend on them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # call-site capture costs several gateway calls per Column; it has no effect on plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


SHUFFLE_PARTITION_BYTES = 192 * 1024 * 1024


def build_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, shuffled_bytes: int) -> int:
    """Set the number of shuffle partitions for the bytes a job will shuffle.

    The adaptive planner joins partitions that turn out small, but never makes more than
    this number, so the default of 200 would give tasks of half a terabyte at 100 TB.
    """
    cores = spark.sparkContext.defaultParallelism
    parts = max(2 * cores, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    return parts


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path object and the file system it lives on."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_new_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False when it is already there (the file system decides the race)."""
    p, fs = hadoop_path(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def _configured_root(spark: SparkSession) -> str | None:
    return (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir")
            or spark.sparkContext.getCheckpointDir())


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the cluster names none, a local master gets a temporary folder (tests) and
    any other master gets the home folder of its default file system. A cluster whose
    default file system is machine-local is refused, because executors would write to
    disks the others cannot read.
    """
    root = _configured_root(spark)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="tidemark-")
    else:
        fs = hadoop_path(spark, "/")[1]
        if fs.getScheme() == "file":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{fs.getHomeDirectory().toString()}/tidemark"
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under :func:`scratch_root`, dropped when the driver JVM ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    p, fs = hadoop_path(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path
