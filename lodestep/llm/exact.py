"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest,
the digests the index lacks are found by a sort-merge anti-join that moves no row of the index,
and appended with the key of the batch. Decisions join the digests of the batch with their winners, so texts never move.
A batch that is run again, because its result was lost after the append, finds its own digests and decides as before.
Each append adds a sorted file to every bucket; :func:`compact` makes one of them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.llm.common import lower_ascii, stored

#: Buckets of a new index: one file each per append.
BUCKETS = 32


def digest(text):
    """SHA-256 of ``text`` in UTF-8 after lower-casing A-Z only, in lower-case hex; NULL counts as empty."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256)


def open_index(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> str:
    """Make the index ``name`` known to this session; its files stay at ``path`` from session to session."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT, batch STRING) USING parquet "
              f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def compact(spark: SparkSession, index: str, name: str, path: str) -> str:
    """Write ``index`` to a new index ``name`` at ``path`` with one sorted file per bucket; the old one stays as it is."""
    buckets = _buckets(spark, index)
    made = open_index(spark, name, path, buckets)
    spark.table(index).repartition(buckets, "digest").sortWithinPartitions("digest").write.insertInto(made)
    return made


def _buckets(spark: SparkSession, index: str) -> int:
    return int(spark.sql(f"DESCRIBE EXTENDED {index}").filter("col_name = 'Num Buckets'").first()[1])


def decide(docs: DataFrame, index: str, doc_id: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
    """Deduplicate a batch against ``index``, append what is new, and return a decision per row.

    Columns: doc_id, keep_id, group_size (rows of the batch with this text), kept, text_sha256.
    Of equal new texts the row with the largest doc_id stays; a text the index already holds keeps
    the doc_id under which it was first stored, and all its rows in the batch go. Of rows that repeat a
    doc_id and its text one stays; a NULL doc_id loses to any other. An empty batch changes nothing. ``batch`` is the key under which the batch is
    appended, by default a hash of its ids and texts: what the index holds under the same key counts as not yet there, so a batch
    that is run again has the same decisions and is not appended twice.
    Other columns of the batch are not looked at. Appending runs when this is called.
    """
    spark = docs.sparkSession
    rows = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), digest(F.col(text)).alias("digest"))
                  .withColumn("row", F.monotonically_increasing_id()), "digests")
    groups = stored(rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size")),
                    "groups")
    if batch is None:
        n, mark = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("doc_id", "digest").cast("decimal(38,0)"))).first()
        batch = f"{n}:{mark}"
    known = spark.table(index).filter(F.col("batch") != batch)
    fresh = groups.hint("merge").join(known.select("digest"), "digest", "left_anti")
    buckets = _buckets(spark, index)
    earlier = groups.hint("merge").join(known, "digest").select("digest", "group_size", "keep_id", F.lit(None).cast("long").alias("row"))
    winners = stored(fresh.select("digest", "group_size", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("row"))
                     .unionByName(earlier), "winners")
    new = winners.filter("row IS NOT NULL").select("digest", "keep_id", F.lit(batch).alias("batch"))
    own = spark.table(index).filter(F.col("batch") == batch).select("digest")
    if not own.isEmpty():  # an earlier run of this batch, whole or not
        new = stored(new.join(own, "digest", "left_anti"), "rest")
    new.repartition(buckets, "digest").sortWithinPartitions("digest").write.insertInto(index)
    return (rows.alias("r").join(winners.alias("w"), "digest")
            .select("r.doc_id", "w.keep_id", "w.group_size", F.coalesce(F.expr("r.row = w.row"), F.lit(False)).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def deduplicate(docs: DataFrame, index: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, decide(docs, index, doc_id, text).filter("kept"), doc_id, text)


def keep_rows(docs: DataFrame, kept: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id is in ``kept``.

    Where ids repeat, ``kept`` tells the rows apart by its column text_sha256 if it has one, and one row of each id
    and text stays.
    """
    by_text = "text_sha256" in kept.columns and docs.groupBy(doc_id).count().filter("count > 1").limit(1).count() > 0
    if not by_text:
        ids = kept.select(F.col("doc_id").alias("_kept_id"))
        return docs.join(ids, docs[doc_id].eqNullSafe(ids["_kept_id"]), "left_semi")
    marked = docs.withColumn("_mark", F.struct(F.col(doc_id).cast("long").alias("doc_id"), digest(F.col(text)).alias("text_sha256")))
    marks = kept.select(F.struct("doc_id", "text_sha256").alias("_kept_mark"))
    return (marked.join(marks, marked["_mark"].eqNullSafe(marks["_kept_mark"]), "left_semi")
            .dropDuplicates(["_mark"]).drop("_mark"))
