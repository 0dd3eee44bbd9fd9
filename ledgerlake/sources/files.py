"""Small files of the lake (markers, lease, manifest) on whatever file system holds it.

Names begin with an underscore, so Spark's readers pass over them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; empty if there is no such folder."""
    p, fs = file_system(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in found if not n.startswith("."))


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Write a small file; without ``overwrite`` an existing one raises FileExistsError."""
    p, fs = file_system(spark, path)
    if not overwrite and fs.exists(p):
        raise FileExistsError(path)
    try:
        out = fs.create(p, overwrite)
    except Exception as e:  # the Java exception of a file that came in between
        if not overwrite and fs.exists(p):
            raise FileExistsError(path) from e
        raise
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None if it is not there."""
    p, fs = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
