"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where a later groupBy would reuse its layout.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    known = getattr(spark, "_lodestep_local_dir", None)
    if known is None:
        known = tempfile.mkdtemp(prefix="lodestep-")
        spark._lodestep_local_dir = known
    return known


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, which :func:`drop_intermediates` deletes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written(spark).append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    Used where several jobs read one intermediate result. It is computed once, its
    lineage ends at the files, so a lost executor costs no recomputation, and later
    plans know its size and read only the columns they need.
    """
    spark = df.sparkSession
    path = new_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, per_task: int, per_core: int = 1) -> DataFrame:
    """``df`` of ``rows`` rows dealt evenly to tasks, one for each ``per_task`` rows and no more than ``per_core`` for each core.

    Spark sizes the tasks of a scan by bytes. Where a narrow row costs much time, as under a model of hundreds of trees, they are too few.
    Few rows stay as they are.
    """
    tasks = min(per_core * df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task))
    return df.repartition(tasks) if tasks > 1 else df


def _written(spark: SparkSession) -> list[str]:
    if not hasattr(spark, "_lodestep_tables"):
        spark._lodestep_tables = []
    return spark._lodestep_tables


def drop_intermediates(spark: SparkSession) -> int:
    """Delete what this session wrote below fresh paths; frames that read it end here."""
    paths = _written(spark)
    count = len(paths)
    for path in list(paths):
        delete_path(spark, path)
    paths.clear()
    return count


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this session wrote below a fresh path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in _written(spark):
        _written(spark).remove(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whichever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)
