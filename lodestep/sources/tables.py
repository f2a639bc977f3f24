"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import path_exists
from .schemas import MAIN_TABLES, REPORT_SCHEMA, SCHEMAS


class Tables:
    """The star around ``users``; every table is a DataFrame in its logical schema.

    A table may be given as a function, which then runs on first use only: a metric that
    reads one table does not plan the other four.
    """

    FIELDS = ("users", "events", "kyc", "transactions", "tickets")

    def __init__(self, users, events, kyc=None, transactions=None, tickets=None):
        self._given = dict(zip(self.FIELDS, (users, events, kyc, transactions, tickets)))
        self.stage_frame = None  # one row per user with its stage times, where an operator has stored it

    def _get(self, name: str) -> DataFrame:
        given = self._given[name]
        if callable(given):
            given = self._given[name] = given()
        return given

    users = property(lambda self: self._get("users"))
    events = property(lambda self: self._get("events"))
    kyc = property(lambda self: self._get("kyc"))
    transactions = property(lambda self: self._get("transactions"))
    tickets = property(lambda self: self._get("tickets"))

    def named(self) -> dict[str, DataFrame]:
        return {name: self._get(field) for name, field in zip(MAIN_TABLES, self.FIELDS)}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """CSV with a header under an explicit schema; None when the file is absent."""
    if not path_exists(spark, path):
        return None
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE", escape='"')


def load_csv_tables(spark: SparkSession, csv_dir: str, out_dir: str,
                    names: Sequence[str] = MAIN_TABLES, mode: str = "overwrite") -> DataFrame:
    """Load ``<csv_dir>/<name>.csv`` into typed parquet and report rows per table.

    Files that are absent are skipped and reported by no row.
    """
    loaded = {}
    for name in names:
        df = read_csv(spark, f"{csv_dir}/{name}.csv", SCHEMAS[name])
        if df is not None:
            df.write.mode(mode).parquet(f"{out_dir}/{name}")
            loaded[name] = spark.read.parquet(f"{out_dir}/{name}")
    return row_counts(loaded, spark)


def row_counts(frames: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], "table_name string, row_count long")
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def load(spark: SparkSession, parquet_dir: str) -> Tables:
    """The five main tables from ``<parquet_dir>/<name>``."""
    return Tables(*[spark.read.schema(SCHEMAS[n]).parquet(f"{parquet_dir}/{n}") for n in MAIN_TABLES])


def load_result(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A result written earlier, or None when it was never written."""
    if not path_exists(spark, path):
        return None
    if fmt == "csv":
        return spark.read.csv(path, header=True, inferSchema=True, escape='"')
    return spark.read.format(fmt).load(path)


def write_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One folder per result, written by all tasks; CSV carries a header."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.csv(path, header=True, escape='"')
    else:
        writer.format(fmt).save(path)


def write_bucketed(df: DataFrame, table: str, key: str = "user_id", buckets: int = 512, mode: str = "overwrite") -> None:
    """Save a fact table bucketed by its join key, so repeated joins on it need no shuffle."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def empty_report(spark: SparkSession) -> DataFrame:
    """A data-quality report without issues."""
    return spark.createDataFrame([], REPORT_SCHEMA)


def cached(tables: Tables) -> Tables:
    """Keep the tables for repeated metrics; spills to disk, lost blocks are recomputed."""
    return Tables(*[df.persist(StorageLevel.MEMORY_AND_DISK) for df in tables.named().values()])


def release(tables: Tables) -> None:
    for df in tables.named().values():
        df.unpersist()
