"""A folder for files that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_used: list[str] = []
_local: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names; where that is unset, a temporary one if all runs on one machine, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="helixframe-"))
        named = _local[0]
    _used.append(f"{named}/files-{uuid.uuid4().hex}")
    return _used[-1]


def kept(df: DataFrame) -> DataFrame:
    """df, written once and read from there: what follows neither repeats its work nor sees it come out otherwise."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Deletes the files of this process that scratch() named, and says how many paths that were. Write the results that read them first."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _used:
        # Writers add endings to the path: all that begin with it go.
        path = jvm.org.apache.hadoop.fs.Path(_used.pop() + "*")
        fs = path.getFileSystem(conf)
        for found in fs.globStatus(path) or []:
            fs.delete(found.getPath(), True)
            n += 1
    return n
