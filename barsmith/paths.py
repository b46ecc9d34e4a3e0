"""Small files and listings through the session's Hadoop FileSystem.

Works for any scheme the cluster is configured for (hdfs, s3a, file). Every error
of the file system is raised: a folder that can't be read is never taken for one
that isn't there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path``; raises where the session has no JVM gateway."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return bool(fs.exists(jpath))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what lies directly in a folder; empty if there is no such folder."""
    fs, jpath = _open(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))


def modification_stamp(spark: SparkSession, path: str) -> str:
    """Path, length and modification time of a file or folder."""
    fs, jpath = _open(spark, path)
    s = fs.getFileStatus(jpath)
    size = fs.getContentSummary(jpath).getLength()
    return f"{s.getPath()}|{size}|{s.getModificationTime()}"


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """Write one small UTF-8 file, without running a Spark job.

    With ``overwrite=False`` the file is only created: False if it is there already.
    """
    fs, jpath = _open(spark, path)
    if not overwrite and fs.exists(jpath):
        return False
    try:
        out = fs.create(jpath, overwrite)
    except Exception as e:
        if not overwrite and "FileAlreadyExists" in str(e):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _open(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _open(spark, path)
    fs.delete(jpath, True)
