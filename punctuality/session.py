"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: Scratch paths handed out inside the open scopes, innermost last.
_scopes: list[list[str]] = []


def get_session(
    master: str | None = None,
    app_name: str = "punctuality",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """A session with AQE on and the UI off.

    On a cluster, pass ``master=None`` and let spark-submit decide;
    ``shuffle_partitions`` is only an upper bound, AQE coalesces small
    partitions after each shuffle.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # No Python call-site capture per DataFrame call (saves py4j round trips).
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Remove checkpoint files (sample candidates) once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local session without one gets a fresh
    folder of its own (as in tests). A cluster without it is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="punctuality-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3) for this job")


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of the path's scheme, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on whatever file system it is; False if there was none."""
    fs, at = _file_system(spark, path)
    return fs.delete(at, True)


def scratch_folder(spark: SparkSession) -> str:
    """This application's own folder under the checkpoint folder; it is deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path in the scratch folder."""
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """What is written to scratch paths inside is deleted at the end, so results that read it must have
    been used or written elsewhere by then. Without a scope, scratch stays until the driver ends."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.remove(made)
        for path in made:
            remove_path(spark, path)


__all__ = ["ensure_checkpoint_dir", "get_session", "path_exists", "remove_path", "scratch_folder", "scratch_path", "scratch_scope"]
