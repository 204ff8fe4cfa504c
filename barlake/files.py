"""Files and folders on any Hadoop file system."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(part.rstrip("/") for part in parts))


def filesystem(spark: SparkSession, path: str):
    target = hadoop_path(spark, path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = filesystem(spark, path)
    return files.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    files, target = filesystem(spark, path)
    files.delete(target, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    files, source = filesystem(spark, path)
    if not files.rename(source, hadoop_path(spark, to)):
        raise OSError(f"cannot move {path} to {to}")


def move_strictly(spark: SparkSession, path: str, to: str) -> bool:
    """Move a folder to a place that must be free, in a folder that must exist; whether it was moved.

    Of several that try, one succeeds; a folder is never moved into another one.
    """
    files, source = filesystem(spark, path)
    target = files.makeQualified(hadoop_path(spark, to))
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(source), target, options)
    except Py4JJavaError as error:
        name = error.java_exception.getClass().getSimpleName()
        if name in ("FileAlreadyExistsException", "FileNotFoundException"):
            return False
        raise
    return True


def remove_others(spark: SparkSession, path: str, names: list[str]) -> None:
    """Delete the folders below ``path`` that are not named."""
    files, root = filesystem(spark, path)
    for status in files.listStatus(root):
        if status.isDirectory() and status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none if there is no such folder."""
    files, root = filesystem(spark, path)
    if not files.exists(root):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(root) if s.isDirectory())


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """The innermost ``name=value`` folders of a partitioned table, relative to it.

    One listing per folder on the driver: at most as many as the table has partitions.
    """
    found = []
    for name in folders(spark, path):
        if "=" in name:
            inner = partition_folders(spark, f"{path}/{name}")
            found += [f"{name}/{child}" for child in inner] or [name]
    return found


def count_files(spark: SparkSession, path: str) -> int:
    """Files that lie in a folder itself, other than hidden ones."""
    files, root = filesystem(spark, path)
    if not files.exists(root):
        return 0
    return sum(s.isFile() and s.getPath().getName()[0] not in "._" for s in files.listStatus(root))


def write_text(spark: SparkSession, path: str, text: str, *, in_folder: bool = False) -> None:
    """Write a small file; ``in_folder`` fails if its folder is not there."""
    files, target = filesystem(spark, path)
    if in_folder and not files.exists(target.getParent()):
        raise FileNotFoundError(path)
    out = files.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, target = filesystem(spark, path)
    source = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
