"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Class of the white space between words, for Java regular expressions: U+0020 and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that driver and executors share.

    Clusters name it in spark.checkpoint.dir. Where that is unset, a temporary folder is made and
    set if all runs on one machine (tests); elsewhere executors could not see it, which is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="helixframe-"))
    return context._jsc.sc().getCheckpointDir().get()


#: Bounds of an Arrow batch that a Python task holds at once; a single longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 16_384, 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Before Python tasks: bounds their batches (the same bounds for every operator, never above the session's own) and lets local workers import this package."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = int(spark.conf.get(name, str(1 << 30)).rstrip("b"))
        if not 0 < now <= most:  # 0 and less stand for no bound
            spark.conf.set(name, str(most))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def whole_text(column: str | Column = "text") -> Column:
    """The text as a string, null as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def documents_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null as empty), and the columns named; other columns are left behind, so none can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *more)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_written: list[str] = []


def stored(df: DataFrame, *, small: bool = False) -> DataFrame:
    """df, written once as Parquet to the shared folder and read from there: a step that survives lost executors.

    What led to it is then no longer needed. Spark deletes the shuffle files of plans that the
    driver has forgotten when its JVM collects garbage, so that is asked for here after a step
    that is not small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    found = spark.read.schema(df.schema).parquet(path)
    del df
    if not small:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return found


def row_keys(docs: DataFrame) -> DataFrame:
    """docs with k1, k2, two hashes of doc_id and text that are null for no row: by them a decision finds its row again."""
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), whole_text()]
    return docs.withColumns({"k1": F.xxhash64(*parts), "k2": F.xxhash64(*parts, F.lit("again"))})


def one_row_each(docs: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """docs with one row for each key, and copies: how many rows have it. rows are the keys of all rows, without texts.

    Only rows whose key repeats are shuffled for it, of which each task first keeps one a key.
    """
    repeated = stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), small=True)
    if repeated.isEmpty():
        return docs.withColumn("copies", F.lit(1).cast("long"))
    alike = stored(docs.join(repeated.select(*key), key, "left_semi").dropDuplicates(key).join(repeated, key))
    return docs.join(repeated.select(*key), key, "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(alike)


def with_counts(rows: DataFrame, groups: DataFrame, key: list[str], n: str, total: int, spread: Column) -> DataFrame:
    """rows left-joined with groups (one row a key, n: how many of the rows have it), also where one key has very many rows.

    Fewer than 1,000 keys can have more than a thousandth of all rows each: those are broadcast, and
    their rows stay where they are. The others are joined by shuffle; spread deals rows that have no
    partner there over all tasks.
    """
    limit = max(total // 1000, 1000)
    rest = [c for c in groups.columns if c not in key]
    hot = F.broadcast(groups.filter(F.col(n) > limit).select(*key, *[F.col(c).alias(f"hot_{c}") for c in rest]))
    # Always 0, but not a constant: Spark would take a constant out of the keys that rows are dealt by.
    cold = groups.filter(F.col(n) <= limit).withColumn("deal", F.pmod(F.col(n), F.lit(1)).cast("long"))
    marked = rows.join(hot, key, "left").withColumn("deal", F.when(F.col(f"hot_{n}").isNull(), F.lit(0).cast("long")).otherwise(spread.bitwiseOR(F.lit(1).cast("long"))))
    joined = marked.join(cold, [*key, "deal"], "left")
    return joined.select(*rows.columns, *[F.coalesce(c, f"hot_{c}").alias(c) for c in rest])


def drop_stored(spark: SparkSession) -> None:
    """Deletes what stored() wrote in this process. Write the results that read it first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
