"""What the corpus operators share: reading, byte-wise lower case, intermediates, caches of workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.session import new_path, path_exists, tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six ASCII white-space characters, inside a character class.
SPACES = r"\x20\x09-\x0D"
#: Rows in one Arrow batch; texts can be long, so a batch holds few.
ROWS_PER_BATCH = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the corpus operators rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    # Intermediates are stored tables, so no later job reads the shuffle files of an earlier one: they go when it ends.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it was."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Array of the words of ``text``, cut at ASCII white space; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), "")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, label: str = "llm") -> DataFrame:
    """Write ``df`` below the shared folder and read it from there; ends its lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files a frame from :func:`stored` reads; nothing may read it afterwards."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete(spark, folder)


def delete(spark: SparkSession, path: str) -> None:
    if path_exists(spark, path):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def per_worker(key, make):
    """``make()`` once in each Python worker process; tasks that follow reuse it."""
    import sys
    import types

    cache = sys.modules.setdefault("_lodestep_worker", types.ModuleType("_lodestep_worker")).__dict__
    if key not in cache:
        cache[key] = make()
    return cache[key]
