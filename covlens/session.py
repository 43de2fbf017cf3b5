"""Session helpers.

The checkpoint/scratch location is read from the session (``spark.checkpoint.dir``).
Only in local mode, and only when none is configured, a temporary one is set; on a
cluster its absence is an error, since executors would not share it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "covlens") -> SparkSession:
    """Session for tests, the bench and command-line use.

    AQE stays on (partition coalescing and skew-join splitting at run time);
    the UI is off because no server may be started.
    """
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-session memos)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a fresh local one only if unset.

    Read from the session configuration, so it also works without a local
    SparkContext (Spark Connect); the context is consulted only as a fallback.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no local context (Spark Connect)
            root = None
    master = spark.conf.get("spark.master", "")
    if not root and master != "local" and not master.startswith("local["):  # local-cluster[...] has other processes
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="covlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # noqa: BLE001 - no local context (Spark Connect)
            pass
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder.

    Written tables that cut lineage, and round-trip layouts, go here so every
    executor sees them and a lost executor can be recomputed from them.
    """
    return f"{checkpoint_root(spark).rstrip('/')}/covlens/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system Spark resolves it to."""
    fs, at = _file_system(spark, path)
    return bool(fs.exists(at))


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder that this library wrote."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it does not exist."""
    fs, at = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()] if fs.exists(at) else []


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below ``path``; none if it does not exist."""
    fs, at = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isFile()] if fs.exists(at) else []


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small new file; fails if it exists."""
    fs, at = _file_system(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Gives a file or folder that this library wrote another name."""
    fs, at = _file_system(spark, old)
    to = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{old} could not be renamed to {new}")
