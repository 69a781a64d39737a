"""Small files of any store that Spark reads, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file, plain or compressed; None for an empty one."""
    jvm = spark._jvm
    store, path = _at(spark, file)
    stream = store.open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(store.getConf()).getCodec(path)
        text = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    store, path = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []


def put(spark: SparkSession, file: str, line: str) -> None:
    """A file with one line."""
    store, path = _at(spark, file)
    stream = store.create(path, False)
    stream.write(bytearray((line + "\n").encode()))
    stream.close()


def renamed(spark: SparkSession, file: str, to: str) -> bool:
    """Gives a file its final name in one step, unless there is one of that name: then False."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext
    store, path = _at(spark, file)
    _, target = _at(spark, to)
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    if store.exists(target):
        return False
    context.getFileContext(path.toUri(), store.getConf()).rename(path, target, none)
    return True


def remove(spark: SparkSession, path: str) -> None:
    store, at = _at(spark, path)
    store.delete(at, True)
