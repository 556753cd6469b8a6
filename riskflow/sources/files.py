"""Small files and folders on any file system that Spark can reach, handled from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.mkdirs(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    files, at = _at(spark, folder)
    return sorted(status.getPath().getName() for status in files.listStatus(at)) if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, at = _at(spark, path)
    source = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A new file, which appears whole or not at all; an error if there is one already."""
    files, at = _at(spark, path)
    if files.exists(at):
        raise FileExistsError(path)
    _, hidden = _at(spark, f"{at.getParent()}/.{at.getName()}.tmp")
    out = files.create(hidden, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not files.rename(hidden, at):
        raise FileExistsError(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """A folder under its final name, all files at once."""
    files, at = _at(spark, target)
    files.mkdirs(at.getParent())
    if not files.rename(_at(spark, source)[1], at):
        raise OSError(f"{source} could not be moved to {target}")


def delete(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)
