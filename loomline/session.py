"""Session helpers: where intermediate tables go."""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Rows and bytes of a batch between the JVM and Python.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session in ``spark.checkpoint.dir``.

    A local-mode session without the setting (tests) gets a fresh temporary
    folder. A cluster session without it is refused: a machine-local folder
    would be lost together with the executor that wrote it.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or getattr(context, "_loomline_dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        configured = context._loomline_dir = tempfile.mkdtemp(prefix="loomline-")
    return configured.rstrip("/")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder path below the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    _hadoop(spark, path, "deleteOnExit")
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme: one without means the default file system, for Spark and for tasks alike.

    A cluster whose default is the local disk is refused: every executor would
    see another folder. Name the scheme (``file://``) where the folder is mounted everywhere.
    The session's own ``spark.checkpoint.dir`` is such a folder, whether it has a scheme or not.
    """
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return path
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    full = system.makeQualified(target).toString()
    if (full.startswith("file:") and not re.fullmatch(r"local(\[[^\]]*\])?", context.master)
            and not _below(path, shared_dir(spark))):
        raise ValueError(f"{path} would be a local folder of each machine; name its scheme")
    return full.removeprefix("file:") if full.startswith("file:") else full


def _below(path: str, folder: str) -> bool:
    path, folder = posixpath.normpath(path), posixpath.normpath(folder)
    return path == folder or path.startswith(f"{folder}/")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a workspace folder as soon as its job no longer needs it."""
    _hadoop(spark, path, "delete", True)


def _hadoop(spark: SparkSession, path: str, method: str, *arguments) -> None:
    jvm = getattr(spark.sparkContext, "_jvm", None)
    if jvm is None:
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    getattr(system, method)(target, *arguments)


def write_once(df: DataFrame, purpose: str) -> DataFrame:
    """Write to Parquet in a workspace folder and read back: for wide tables that several passes need."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    directory = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(directory)
    return df.checkpoint(eager=True)


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send texts to Python in batches of at most ``rows`` rows from now on, unless the session has fewer.

    A batch stands several times in memory outside the heap, in the executor and in its workers. A batch of
    long rows ends at BATCH_BYTES, unless the session names its own limit.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per Spark application.

    Not needed where it is installed on the executors or passed with ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_loomline_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="loomline-code-")) / "loomline_package.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._loomline_shipped = True
