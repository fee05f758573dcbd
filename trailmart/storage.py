"""Small things done with the file system that a path belongs to, whichever it is."""

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _file_system(spark, path)
    return system.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none when it is not there."""
    system, folder = _file_system(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def delete(spark: SparkSession, path: str) -> None:
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    system, file = _file_system(spark, path)
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small new file; False when there is one already."""
    system, file = _file_system(spark, path)
    if system.exists(file):
        return False
    stream = system.create(file, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return True
