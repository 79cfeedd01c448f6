"""Files of any store that Spark reads, through its own file systems: marks, listings, and the one write that only one of several can make."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _at(spark, path)
    return store.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if it is not there."""
    place, store = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    place, store = _at(spark, path)
    store.delete(place, True)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless there is one; of several writers exactly one gets True.

    The content is complete before the name is taken: a reader never sees half of it. Stores with a conditional create (HDFS, object stores
    with if-none-match) decide by it; elsewhere the rename of a finished file to a name that must be free does.
    """
    place, store = _at(spark, path)
    if store.exists(place):
        return False
    if store.getScheme() == "file":
        # the local file system has no create that fails if the name is taken: a hard link does
        import os
        import tempfile

        target = place.toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(target), prefix=".", delete=False, encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(f.name, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(f.name)
    try:
        out = store.create(place, False)
    except Exception as taken:
        if store.exists(place):
            return False
        raise taken
    try:
        out.write(text.encode())
    finally:
        out.close()
    return True


def text_of(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    return spark.read.text(path, wholetext=True).first()[0]
