"""Intermediate results that are used more than once, kept as files all executors can reach."""

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_MADE: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of the shared warehouse where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append((spark, path))
    return path


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Writes ``df`` once and reads it back, so that later steps and lost executors reread files.

    The files are removed when the program ends, since frames made from them are read lazily.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove() -> None:
    for spark, path in _MADE:
        context = spark.sparkContext
        try:
            if context._jsc is None or context._jsc.sc().isStopped():
                continue
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        except (Py4JError, OSError):  # the session's Java side has ended before
            return
