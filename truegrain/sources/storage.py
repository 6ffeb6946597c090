"""Small acts on files through the file system that a path names, local or remote; data itself goes through Spark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def uri(spark: SparkSession, path: str) -> str:
    """A path as Spark's ``_metadata.file_path`` has it, odd characters encoded."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, place = located(spark, path)
    return system.exists(place)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of all files below a folder, by path; names that start with ``_`` or ``.`` are left out."""
    system, place = located(spark, path)
    found, todo = [], [system.getFileStatus(place)]
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [x for x in system.listStatus(status.getPath()) if x.getPath().getName()[0] not in "_."]
        else:
            found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def some_bytes(spark: SparkSession, path: str, start: int, n: int) -> bytes:
    """At most ``n`` bytes of a file."""
    system, place = located(spark, path)
    stream = system.open(place)
    try:
        stream.seek(start)
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all; an error if it is there already."""
    system, place = located(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.draft")
    stream = system.create(draft, True)
    stream.write(text.encode())
    stream.close()
    if system.exists(place) or not system.rename(draft, place):
        raise FileExistsError(path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, in order; none if it isn't there."""
    system, place = located(spark, path)
    if not system.exists(place):
        return []
    return sorted(x.getPath().getName() for x in system.listStatus(place))
