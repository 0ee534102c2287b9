"""Session construction and lineage cutting.

On a cluster the session is built by whoever submits the job; the library
only reads its settings.  ``build_session`` exists for tests, the bench and
local runs.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed around.  AQE re-plans joins at run
# time (broadcast when a side turns out small, split skewed partitions),
# and coalesces the many small shuffle partitions that tiny inputs give.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove reliable-checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "playlens",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra_conf: dict[str, str] | None = None,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster).

    ``checkpoint_dir`` names the folder of the checkpoints; without it and
    without the setting the session gets a scratch folder.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    folder = {"spark.checkpoint.dir": checkpoint_dir} if checkpoint_dir else {}
    for key, value in {**DEFAULT_CONF, **folder, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a directory, and return it.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one
    is used whenever it is set.  Only a local-mode session without the
    setting (tests, the bench) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS / object store) so checkpoints survive executor loss"
        )
    local_dir = tempfile.mkdtemp(prefix="playlens-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a reliable checkpoint in the shared folder.

    Used where a result must not change if it is recomputed (range
    boundaries drawn from a sample, row order inside partitions).
    Reliable checkpoints survive the loss of the executors that wrote them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table next to the checkpoints, in a folder that goes with the driver's JVM."""
    folder = os.path.join(ensure_checkpoint_dir(spark), "scratch")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return os.path.join(folder, name)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a written intermediate table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the configured folder of the checkpoints itself, where a later session finds it again.

    Spark gives the checkpoints of every session a folder of their own; that
    one is used where the setting is missing (tests, the bench).
    """
    return os.path.join(spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark), name)


#: Bytes that the rows on their way to the blocks of a job take at most; a job that needs more runs in several waves.
WAVE_BYTES = 4 << 30

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock = threading.Lock()
_cleanup_held: dict = {}


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Shuffle files of the jobs started inside are deleted when the job ends, not at some later collection of garbage.

    For jobs whose result is written and that are not run again.  The setting
    is the session's: jobs of other threads that start meanwhile lose their
    files at their end too, and make them again where they are run twice.
    """
    app = spark.sparkContext.applicationId
    with _cleanup_lock:
        before, users = _cleanup_held.get(app, (None, 0))
        if not users:
            before = spark.conf.get(CLEANUP)
            spark.conf.set(CLEANUP, "true")
        _cleanup_held[app] = (before, users + 1)
    try:
        yield
    finally:
        with _cleanup_lock:
            before, users = _cleanup_held.pop(app)
            if users > 1:
                _cleanup_held[app] = (before, users - 1)
            else:
                spark.conf.set(CLEANUP, before)


def written_in_waves(spark: SparkSession, name: str, waves: Iterable[DataFrame]) -> DataFrame:
    """The rows of all ``waves``, run one after the other, written to a scratch table and read again.

    Pass a generator where making a wave runs jobs of its own.  Every wave's shuffle files are deleted before the next one starts, so
    that the disk holds the shuffles of one wave and the rows of all.
    """
    path, schema = scratch_path(spark, f"{name}-{uuid.uuid4().hex}"), None
    with shuffles_deleted(spark):
        for df in waves:
            schema = df.schema
            df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
