"""File-system metadata calls through the Hadoop FileSystem of the session.

Only metadata (existence, listings of log/stat folders) goes through here; it
works the same on local disk, HDFS or an object store. Data never does.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified URI, the form ``_metadata.file_path`` and ``inputFiles`` use."""
    fs, p = _fs_and_path(spark, path)
    return str(fs.makeQualified(p).toUri().toString())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Child names of a directory (empty when it does not exist)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(st.getPath().getName()) for st in fs.listStatus(p))


class AlreadyExists(FileExistsError):
    pass


def create_new(spark: SparkSession, path: str, content: str | bytes) -> None:
    """Write a small metadata file, failing if it exists (exclusive create).

    One file-system call instead of a Spark job: used for commit rows, which
    are a few hundred bytes. On HDFS and local disk the create is atomic, so
    two writers of the same path cannot both succeed.
    """
    fs, p = _fs_and_path(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:  # py4j wraps FileAlreadyExistsException
        if "FileAlreadyExistsException" in str(e) or "already exists" in str(e):
            raise AlreadyExists(path) from e
        raise
    try:
        out.write(bytearray(content.encode("utf-8") if isinstance(content, str) else content))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Whole content of a small metadata file (one file-system call)."""
    fs, p = _fs_and_path(spark, path)
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()
