"""Session helpers: shared scratch tables and table loading."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: list[str] = []
_FOLDERS: set[str] = set()
_WRITTEN: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``.

    Only a ``local[...]`` master may fall back to a temporary folder, since
    there driver and executors are the same process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _LOCAL_DIR:
        _LOCAL_DIR.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _LOCAL_DIR[0]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage: later stages, and retries after an executor is lost, reread
    the files and recompute nothing. ``release`` or the end of the driver's JVM
    removes the files.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[id(out)] = path
    weakref.finalize(out, _WRITTEN.pop, id(out), None)
    return out


def discard(written: DataFrame) -> None:
    """Delete the files of a ``materialize`` result that nothing will read again."""
    delete(written.sparkSession, _WRITTEN[id(written)])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's scratch folder."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession) -> str:
    """The application's scratch folder; the JVM deletes it when it ends, also after ``spark.stop()``."""
    path = f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}"
    if path not in _FOLDERS:
        fs, folder = _at(spark, path)
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _FOLDERS.add(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete all scratch tables of the application. Results not yet read are lost."""
    path = _folder(spark)
    delete(spark, path)
    _FOLDERS.discard(path)


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path; one that is not there is no error."""
    fs, target = _at(spark, path)
    if not fs.delete(target, True) and fs.exists(target):
        raise OSError(f"cannot delete {path}")


def share_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a file to the shared folder and ship it; ``SparkFiles.get`` of the returned name finds it on every executor."""
    path = scratch(spark, name)
    fs, target = _at(spark, path)
    out = fs.create(target, True)
    try:
        for at in range(0, len(content), 1 << 22):
            out.write(bytearray(content[at : at + (1 << 22)]))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One driver table: a Parquet file or directory ``<root>/<name>.parquet``."""
    return spark.read.parquet(f"{root}/{name}.parquet")
