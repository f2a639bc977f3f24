"""Bounded-space online packing of token ids into sequences.

Every partition keeps a fixed number of open windows. A document's whole windows go out at once; its remainder
goes into the open window it fits best. Where it fits none, the fullest window is topped up with the head of the
remainder, if the gap is worth a cut, and emitted. What is open at the end is merged, sixteen partitions at a
time, by the same rule, until one group is left, whose windows are filled one after the other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.common import ROWS_PER_BATCH, stored
from lodestep.llm.tokens import encoder

WINDOW = 1024
OPEN_WINDOWS = 64
#: A smaller gap in the window to emit is padded; a larger one is filled by cutting the piece at hand.
MIN_CUT = 8
MERGED_AT_ONCE = 16
END_ID = 0

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, open boolean, ids binary"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_ARROW = pa.schema([(n, {"boolean": pa.bool_(), "binary": pa.binary()}.get(t, pa.int64())) for n, t in (c.split() for c in SCHEMA.split(", "))])


class Packer:
    """Windows of one task. A piece is (doc_id, start, doc_tokens, ids)."""

    def __init__(self, first_id: int, size: int, windows: int, with_ids: bool):
        self.next_id, self.size, self.windows, self.with_ids = first_id, size, windows, with_ids
        self.open: list[list] = []  # [room, pieces]
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple], is_open: bool = False) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            raw = ids.astype("<u4").tobytes()
            self.rows.append((doc_id, start, len(ids), zlib.crc32(raw), total, self.next_id, offset, is_open, raw if is_open or self.with_ids else None))
            offset += len(ids)
        self.next_id += 1

    def place(self, piece: tuple) -> None:
        while True:
            doc_id, start, total, ids = piece
            n = len(ids)
            best = min((w for w in self.open if w[0] >= n), key=lambda w: w[0], default=None)
            if best is None and len(self.open) < self.windows:
                best = [self.size, []]
                self.open.append(best)
            if best is not None:
                best[0] -= n
                best[1].append(piece)
                if best[0] == 0:
                    self.open.remove(best)
                    self.emit(best[1])
                return
            fullest = min(self.open, key=lambda w: w[0])
            self.open.remove(fullest)
            room = fullest[0]
            if room >= MIN_CUT:
                fullest[1].append((doc_id, start, total, ids[:room]))
                piece = doc_id, start + room, total, ids[room:]
            self.emit(fullest[1])

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.size
        for at in range(0, whole, self.size):
            self.emit([(doc_id, at, len(ids), ids[at:at + self.size])])
        if whole < len(ids):
            self.place((doc_id, whole, len(ids), ids[whole:]))

    def close(self) -> None:
        """Fill the open windows one after the other; only the last stays short."""
        pieces, room, out = [p for w in self.open for p in w[1]], self.size, []
        self.open = []
        for doc_id, start, total, ids in pieces:
            while len(ids):
                head = ids[:room]
                out.append((doc_id, start, total, head))
                ids, start, room = ids[len(head):], start + len(head), room - len(head)
                if not room:
                    self.emit(out)
                    room, out = self.size, []
        if out:
            self.emit(out)

    def leave(self) -> None:
        for _, pieces in self.open:
            self.emit(pieces, True)

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in _COLUMNS]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)


def _first_id(round_number: int, part: int) -> int:
    return round_number << 58 | part << 32


def _merger(number: int, last: bool, size: int, windows: int, with_ids: bool):
    """What packs the open windows of a few partitions again."""

    def merge(key, table):
        packer = Packer(_first_id(number, key[0].as_py()), size, windows, with_ids)
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        for doc, start, total, raw in zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))):
            packer.place((doc, start, total, np.frombuffer(raw, "<u4")))
        packer.close() if last else packer.leave()
        return pa.Table.from_batches([_batch(packer.take())])

    return merge


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW, windows: int = OPEN_WINDOWS,
         with_ids: bool = True) -> DataFrame:
    """Pieces of the packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document's ids are those of the tokenizer file ``path`` and END_ID after them, so a NULL or empty text has one id. Each id
    lies in one piece; sequence_id is unique, offsets run from 0 without gaps. Repeated rows are packed each for itself;
    an empty table gives no pieces. ``ids``: little-endian unsigned 32-bit ids, NULL without ``with_ids``. Other columns are not
    looked at. Runs when called.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([END_ID], np.uint32)
        packer = Packer(_first_id(0, TaskContext.get().partitionId()), size, windows, with_ids)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for key, value in zip(ids, texts):
                content = value.as_py()
                packer.add(key, np.concatenate([encode(content), end]) if content else end)
                if len(packer.rows) >= ROWS_PER_BATCH:
                    yield _batch(packer.take())
        packer.leave()
        yield _batch(packer.take())

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    now = stored(rows.mapInArrow(first, SCHEMA), "packed")
    done, number = [now], 0
    left = now.filter("open").withColumn("part", F.expr("shiftright(sequence_id, 32) & 67108863"))
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        number += 1
        last = parts <= MERGED_AT_ONCE

        group = F.expr(f"CAST(part DIV {MERGED_AT_ONCE} AS BIGINT)")
        now = stored(left.select(group.alias("part"), *_COLUMNS).groupBy("part")
                     .applyInArrow(_merger(number, last, size, windows, with_ids), SCHEMA), "merged")
        done.append(now)
        if last:
            break
        parts = -(-parts // MERGED_AT_ONCE)
        left = now.filter("open").withColumn("part", F.expr("shiftright(sequence_id, 32) & 67108863"))
    out = done[0].filter("NOT open")
    for more in done[1:]:
        out = out.unionByName(more.filter("NOT open"))
    return out.drop("open")
