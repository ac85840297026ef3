"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans are tuned for. A cluster's own values win: they are only
# applied when this module builds the session.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Plans are built from many small expressions; not recording a call site for
    # each of them halves the time to build one.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def spark_session(
    app_name: str = "tradewind",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Build (or get) a session with the settings the plans expect.

    ``shuffle_partitions`` is an upper bound on a cluster: adaptive execution
    merges small partitions, so choose it from the largest shuffle (about
    128 MB per partition) and leave it alone for the small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master; a cluster without the
    setting is refused because a machine-local folder would be lost with its
    executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tradewind-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, which ``delete_scratch`` removes."""
    path = f"{shared_folder(spark).rstrip('/')}/tradewind-{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def delete_scratch(spark: SparkSession) -> None:
    """Remove what was written to scratch paths so far; frames that read it end there."""
    configuration = spark._jsc.hadoopConfiguration()
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(configuration).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the shared folder unless that is done already."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
