"""Session set-up and the shared folder for data that outlives a task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_folders: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: int | str = "*", name: str = "foyer", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster, submit sets these."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the folder deleted when the driver's JVM ends."""
    if hasattr(spark, "_jvm"):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, empty path every executor can reach, below ``spark.checkpoint.dir``.

    It is deleted when the application ends. Where the setting is absent, a local session gets a
    temporary folder; a cluster session is refused, as its executors would not see a folder of
    the driver.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    context = spark.sparkContext
    if not root:
        if not context.master.startswith("local["):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
        owner = _own_folders.setdefault(
            context.applicationId,
            tempfile.TemporaryDirectory(prefix="foyer-", ignore_cleanup_errors=True),
        )
        root = owner.name
    folder = f"{root.rstrip('/')}/foyer/{name}-{uuid.uuid4().hex}"
    _delete_at_exit(spark, folder)
    return folder
