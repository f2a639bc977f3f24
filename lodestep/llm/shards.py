"""Training-order materialisation: token sequences in a keyed random order, as fixed-stride binary shards.

Every partition cuts its documents' ids into sequences of equal length. A sequence's number in the corpus (sequences of
earlier partitions, plus its place in its own) goes through a keyed Feistel permutation of 0..N-1, with
cycle-walking, to its slot. Slots are dealt by range: a shard holds a fixed run of them, sorted, one record each. All
records have the same size, so the record of a slot stands at a known place of a known file, and a reader can
start or resume anywhere and read on in sequence.

A record is the ids as little-endian unsigned integers, two bytes wide where the vocabulary allows, and one line feed.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.llm.common import drop_stored, stored
from lodestep.llm.tokens import encoder

STRIDE = 1024
SHARD_SEQUENCES = 8192
END_ID = 0
ROUNDS = 6
KEY = 20240229
#: Ranges of slots written one after another; only one of them is in a shuffle at a time, so that much of the data lies on disk twice.
PASSES = 3


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def permuted(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """Slots of the numbers: a keyed permutation of 0..count-1."""
    half = np.uint64(max(1, -(-(max(count, 2) - 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    with np.errstate(over="ignore"):
        keys = _mixed(np.uint64(key) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> half, x & mask
            for k in keys:
                left, right = right, left ^ _mixed(right + k) & mask
            return left << half | right

        out = once(numbers.astype(np.uint64))
        while (out >= count).any():  # walk the cycle back into the range
            far = out >= count
            out[far] = once(out[far])
    return out.astype(np.int64)


def slot(number: Column, count: int, key: int) -> Column:
    """The slot of a sequence number."""

    @F.pandas_udf("long")
    def walk(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), count, key))

    return walk(number)


def width(path: str) -> int:
    """Bytes of an id of the tokenizer file."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def sequences(docs: DataFrame, path: str, text: str = "text", stride: int = STRIDE) -> DataFrame:
    """part, number, ids: the ids of each partition's documents, END_ID after each, cut every ``stride``; the last is filled with END_ID."""
    kind = f"<u{width(path)}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        part, number = TaskContext.get().partitionId(), 0
        end = np.array([END_ID], kind)
        rest = np.zeros(0, kind)

        def rows(whole: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            found = [x.tobytes() for x in whole.reshape(-1, stride)]
            at = np.arange(number, number + len(found))
            number += len(found)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), part), pa.int64()), pa.array(at, pa.int64()), pa.array(found, pa.binary())],
                                              ["part", "number", "ids"])

        for batch in batches:
            pieces = [rest]
            for value in batch.column(0):
                content = value.as_py()
                if content:
                    pieces.append(encode(content).astype(kind))
                pieces.append(end)
            flat = np.concatenate(pieces)
            whole = len(flat) - len(flat) % stride
            rest = flat[whole:]
            if whole:
                yield rows(flat[:whole])
        if len(rest):
            yield rows(np.concatenate([rest, np.full(stride - len(rest), END_ID, kind)]))

    return docs.select(F.col(text)).mapInArrow(cut, "part long, number long, ids binary")


def write(docs: DataFrame, path: str, target: str, text: str = "text", stride: int = STRIDE, shard: int = SHARD_SEQUENCES, key: int = KEY) -> dict:
    """Write the shards of ``docs`` below ``target`` and return their manifest.

    NULL and empty texts are one END_ID; repeated rows are written again; an empty table gives a manifest of no
    sequences and no shard. Other columns are not looked at. The same documents, partitions and key give the same files.
    """
    spark = docs.sparkSession
    made = stored(sequences(docs, path, text, stride), "sequences")
    # One row for each task that wrote sequences.
    sizes = made.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    count = sum(r["n"] for r in sizes)
    manifest = {"sequences": count, "stride": stride, "width": width(path), "shard": shard, "key": key}
    if count:
        first = np.cumsum([0, *(r["n"] for r in sizes)])[:-1].tolist()
        begins = spark.createDataFrame([(r["part"], b) for r, b in zip(sizes, first)], "part long, begin long")
        shards = -(-count // shard)
        dealt = (made.join(F.broadcast(begins), "part")  # a row for each task
                 .select(slot(F.col("begin") + F.col("number"), count, key).alias("slot"), "ids")
                 .withColumn("shard", F.expr(f"slot DIV {shard}")))
        each = -(-shards // PASSES)
        for first in range(0, shards, each):
            last = min(first + each, shards) - 1
            (dealt.filter(F.col("shard").between(first, last)).repartitionById(last - first + 1, (F.col("shard") - first).cast("int"))
             .sortWithinPartitions("shard", "slot").select("shard", F.col("ids").cast("string").alias("value"))
             .write.mode("append" if first else "error").partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(target))
    drop_stored(made)
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{target}/_manifest")
    return manifest


def manifest(spark: SparkSession, target: str) -> dict:
    return json.loads(spark.read.text(f"{target}/_manifest").first()[0])


def read(spark: SparkSession, target: str, start: int = 0, end: int | None = None) -> DataFrame:
    """slot, shard, offset (byte in the shard's file), ids (little-endian bytes) of the slots from ``start`` to before ``end``, from the files."""
    known = manifest(spark, target)
    end = known["sequences"] if end is None else min(end, known["sequences"])
    shape = "slot long, shard long, offset long, ids binary"
    size, per = known["stride"] * known["width"], known["shard"]
    if start >= end:
        return spark.createDataFrame([], shape)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = memoryview(content.as_buffer())
                if len(data) % (size + 1) or any(data[i] != 10 for i in range(size, len(data), size + 1)):
                    raise ValueError(f"shard {number} is not a whole number of records")
                at = [i for i in range(len(data) // (size + 1)) if start <= number * per + i < end]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number * per + i for i in at], pa.int64()), pa.array([number] * len(at), pa.int64()),
                     pa.array([i * (size + 1) for i in at], pa.int64()), pa.array([bytes(data[i * (size + 1):i * (size + 1) + size]) for i in at], pa.binary())],
                    ["slot", "shard", "offset", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target)
    return (files.filter(F.col("shard").between(start // per, (end - 1) // per)).select(F.col("shard").cast("long").alias("shard"), "content")
            .mapInArrow(records, shape))


def checked(found: DataFrame) -> DataFrame:
    """slot, shard, offset, n_ids bytes and CRC-32 of the ids of records."""

    @F.pandas_udf("long")
    def crc(ids: pd.Series) -> pd.Series:
        return ids.map(zlib.crc32).astype("int64")

    return found.select("slot", "shard", "offset", F.octet_length("ids").cast("long").alias("n_bytes"), crc("ids").alias("ids_crc32"))
