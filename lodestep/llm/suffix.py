"""Removal of repeated byte strings by bucket-pointer refinement over a sample of suffixes.

Which bytes does a string of LENGTH bytes cover that also starts elsewhere? Sorting all suffixes would move a
row per byte. Here the suffixes around anchors are sorted: an anchor is the least q-gram hash of every string of
LENGTH bytes, so equal strings have equal anchors at equal places, and about one byte in seventy is one.

1. Buckets: anchors by the identifier of their q-gram; a bucket of one is done.
2. Anchors whose whole surroundings are equal are one class; a class of two or more is done, every string around its
   anchors repeats.
3. Refinement of the other classes of a bucket, for the strings that start up to LENGTH - q bytes before the anchor: the suffixes at
   each offset from the anchor have a bucket by their q-gram; a bucket is refined by sorting on the buckets of later offsets, and the
   refined buckets are the pointers of the next refinement, until they stand for LENGTH bytes. A bucket of one takes no part any more.
4. A bucket too large for one task is dealt out first: first half and second half of its starts, by a hash of the bytes that all strings of the
   half share, and so on, down to single strings, where two in a bucket repeat. No bucket is held in one place beyond a fixed size.

All strings around an anchor contain it, so what they cover is one run, given by the first and the last start that repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.common import drop_stored, stored

LENGTH, GRAM = 200, 64
#: Largest bucket that one task settles.
BUCKET = 512
#: Bytes hashed at a time; longer texts are cut into overlapping pieces.
PIECE = 1 << 20

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any substring follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=out[1:])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of values[i:i + width] for each full window."""
    n = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, values[-1], values.dtype)]).reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, identifiers) of the anchors in texts that stand one after the other and end at ``ends``."""
    width = length - gram + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = _sums(data)
    grams = _mixed((sums[gram:] - sums[:-gram]) * _powers(_INVERSE, len(data) - gram + 1)) | np.uint64(1)
    least = _sliding(grams, width, np.minimum)  # for each start of a string
    begins = np.concatenate([[0], ends[:-1]])
    whole = np.zeros(len(data) + 1, np.int64)  # 1 where a string lies within its text
    long = ends - begins >= length
    np.add.at(whole, begins[long], 1)
    np.add.at(whole, ends[long] - length + 1, -1)
    least[np.cumsum(whole)[:len(least)] == 0] = 0
    # an anchor is the least of some string that holds it: of the strings starting up to width - 1 before it
    around = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    at = np.flatnonzero(around[:len(grams)] == grams)
    return at, grams[at]


def _pieces(raw: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, first, last): pieces of a long text, and the positions each of them answers for."""
    for first in range(0, len(raw), PIECE):
        last = min(first + PIECE, len(raw))
        yield max(0, first - 2 * LENGTH), min(len(raw), last + 2 * LENGTH), first, last


def _anchored(texts: DataFrame) -> DataFrame:
    """doc_id, mark, pos, gram, around: each anchor with the identifiers of its q-gram and of its whole surroundings."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def solve(held: list[tuple]) -> pa.RecordBatch:
            data = np.frombuffer(b"".join(raw[a:b] for _, raw, a, b, _, _ in held), np.uint8)
            ends = np.cumsum([b - a for _, _, a, b, _, _ in held])
            at, gram = anchors(data, ends, LENGTH, GRAM)
            piece = np.searchsorted(ends, at, side="right")
            offset = np.array([a - e + (b - a) for (_, _, a, b, _, _), e in zip(held, ends)])
            pos = at + offset[piece]
            mine = (pos >= np.array([x[4] for x in held])[piece]) & (pos < np.array([x[5] for x in held])[piece])
            pos, gram, piece = pos[mine], gram[mine], piece[mine]
            around = np.fromiter((xxhash.xxh3_64_intdigest(held[k][1][max(0, p - LENGTH + GRAM):p + LENGTH], min(p, LENGTH - GRAM))
                                  for k, p in zip(piece.tolist(), pos.tolist())), np.uint64, len(pos))
            where = pa.array(np.array([x[0] for x in held])[piece])
            return where, pa.array(pos.astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(around.view(np.int64))

        names = ["doc_id", "mark", "pos", "gram", "around"]
        for batch in batches:
            held, size = [], 0
            texts = batch.column("raw").to_pylist()
            for row, raw in enumerate(texts):
                if len(raw) >= LENGTH:
                    for piece in _pieces(raw):
                        held.append((row, raw, *piece))
                        size += piece[1] - piece[0]
                        if size >= PIECE:
                            where, *rest = solve(held)
                            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(where), batch.column("mark").take(where), *rest], names)
                            held, size = [], 0
            if held:
                where, *rest = solve(held)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(where), batch.column("mark").take(where), *rest], names)

    return texts.mapInArrow(find, "doc_id long, mark long, pos int, gram long, around long")


def _contexts(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of _CONTEXT: each class with the bytes around its first anchor."""
    wanted = classes.groupBy(F.col("at.doc_id").alias("of"), F.col("at.mark").alias("marked")).agg(
        F.collect_list(F.struct("at.pos", "gram", "around", "single")).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, places in zip(batch.column("raw").to_pylist(), batch.column("places").to_pylist()):
                for x in places:
                    p = x["pos"]
                    rows.append((x["gram"], x["gram"], x["around"], x["single"], min(p, LENGTH - GRAM), raw[max(0, p - LENGTH + GRAM):p + LENGTH],
                                 0, LENGTH - GRAM, None))
            yield _rows(rows)

    joined = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["of"]) & (texts["mark"] == wanted["marked"]))
    return joined.select("raw", "places").mapInArrow(cut, _CONTEXT)


_CONTEXT = "key long, gram long, around long, single boolean, left int, bytes binary, low int, high int, whole long"
_TYPES = pa.schema([("key", pa.int64()), ("gram", pa.int64()), ("around", pa.int64()), ("single", pa.bool_()), ("left", pa.int32()),
                    ("bytes", pa.binary()), ("low", pa.int32()), ("high", pa.int32()), ("whole", pa.int64())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in _TYPES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES.types)], schema=_TYPES)


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of large buckets under the identifier of what all strings of either half of their starts share; ``whole``
    identifies all the bytes these strings cover, where the row has them."""
    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x

    for batch in batches:
        rows = []
        for x in batch.to_pylist():
            middle = (x["low"] + x["high"]) // 2
            for low, high in ((x["low"], middle), (middle + 1, x["high"])):
                # starts ``s`` bytes before the anchor are within the bytes from LENGTH - right to left
                if low <= high and max(low, LENGTH - (len(x["bytes"]) - x["left"])) <= min(high, x["left"]):
                    key = signed(xxhash.xxh3_64_intdigest(x["bytes"][x["left"] - low:x["left"] + LENGTH - high], x["key"] & 0xFFFFFFFF))
                    inside = high <= x["left"] and x["left"] + LENGTH - low <= len(x["bytes"])
                    whole = signed(xxhash.xxh3_64_intdigest(x["bytes"][x["left"] - high:x["left"] + LENGTH - low])) if inside else None
                    rows.append((key, x["gram"], x["around"], x["single"], x["left"], x["bytes"], low, high, whole))
        yield _rows(rows)


def _sorted_names(*pointers: np.ndarray) -> np.ndarray:
    """The bucket of each row among those with equal ``pointers``, by stable sorts from the last to the first; 0 for a bucket of one."""
    order = np.argsort(pointers[-1], kind="stable" if len(pointers) > 1 else None)
    for p in pointers[-2::-1]:
        order = order[np.argsort(p[order], kind="stable")]
    fresh = np.ones(len(order) + 1, bool)
    fresh[1:-1] = np.logical_or.reduce([p[order][1:] != p[order][:-1] for p in pointers])
    names = np.cumsum(fresh[:-1])
    names[fresh[:-1] & fresh[1:]] = 0
    out = np.empty(len(order), np.int64)
    out[order] = names
    return out


def _starts(number: np.ndarray, low: np.ndarray, high: np.ndarray, left: np.ndarray, content: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(before, after) of each row: the first and last start, low to high bytes before the anchor, whose string another row of its
    bucket ``number`` repeats; -1 without one. ``left`` is the place of the anchor in the row's bytes.

    Buckets of q-grams at each offset from the anchor are refined twice by sorting on the buckets of later offsets: 64 bytes by
    those 64 further on to 128, these by those 72 further on to 200. A row alone in a bucket takes no part in longer ones.
    """
    size = np.fromiter(map(len, content), np.int64, len(content))
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(content), np.uint8)
    sums, back = _sums(data), _powers(_INVERSE, len(data) + 1)
    salt = _mixed(number * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    reach = LENGTH - GRAM
    step = LENGTH - 2 * GRAM  # from a 128-gram to the one that ends where the string ends
    # names fit two bytes, which are sorted by radix, as long as the rows do
    kind = np.uint16 if len(content) < 1 << 16 else np.uint32
    names = np.zeros((2 * reach + 1, len(content)), kind)  # at offset o: row o + reach

    def grams(live: np.ndarray, o: int) -> np.ndarray:
        """Names the q-grams at offset ``o`` of the live rows; returns the rows that are not alone."""
        # strings over this q-gram start -o (or further) to reach - o (or nearer) bytes before the anchor
        live = live[(o >= -left[live]) & (o + GRAM <= size[live] - left[live]) & (o >= -high[live]) & (o <= reach - low[live])]
        start = begin[live] + left[live] + o
        names[o + reach, live] = _sorted_names(_mixed((sums[start + GRAM] - sums[start]) * back[start]) ^ salt[live])
        return live[names[o + reach, live] > 0]

    least, most = int(low.min()), int(high.max())
    # A string over an outer q-gram lies over those between it and the anchor too, so a row alone in one of them is out.
    for offsets in (range(reach - least + 1), range(-1, -most - 1, -1)):
        live = np.arange(len(content))
        for o in offsets:
            live = grams(live, o)

    def refined(buckets: np.ndarray, o: int, further: int) -> np.ndarray:
        own, later = buckets[o + reach], buckets[o + further + reach]
        both = np.flatnonzero((own > 0) & (later > 0))
        out = np.zeros(len(content), kind)
        if len(both):
            out[both] = _sorted_names(own[both], later[both])
        return out

    double = np.zeros_like(names)
    for o in range(-most, step - least + 1):
        double[o + reach] = refined(names, o, GRAM)
    before, after = np.full(len(content), -1, np.int64), np.full(len(content), -1, np.int64)
    for s in range(least, most + 1):
        twice = np.flatnonzero((refined(double, -s, step) > 0) & (s >= low) & (s <= high))
        before[twice] = s
        after[twice[after[twice] < 0]] = LENGTH - s
    return before, after


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, around, before, after of classes of one anchor: first and last start that repeats in their bucket.

    A partition is sorted by bucket, and a bucket may go on in the next batch.
    """

    def solve(table: pa.Table) -> pa.RecordBatch:
        bucket = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "low", "high")], axis=1)
        number = np.cumsum(np.r_[False, (bucket[1:] != bucket[:-1]).any(axis=1)]).astype(np.uint64)
        before, after = _starts(number, bucket[:, 1], bucket[:, 2], table.column("left").to_numpy().astype(np.int64), table.column("bytes").to_pylist())
        hit = (before >= 0) & table.column("single").to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays(
            [table.column("gram").to_numpy()[hit], table.column("around").to_numpy()[hit], before[hit].astype(np.int32), after[hit].astype(np.int32)],
            ["gram", "around", "before", "after"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < 16 * BUCKET:
            continue
        table = pa.Table.from_batches(held)
        bucket = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "low", "high")], axis=1)
        changes = np.flatnonzero((bucket[1:] != bucket[:-1]).any(axis=1)) + 1
        cut = int(changes[-1]) if len(changes) else 0
        if cut:
            yield solve(table.slice(0, cut).combine_chunks())
        held, rows = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if held:
        yield solve(pa.Table.from_batches(held).combine_chunks())


def _refined(contexts: DataFrame) -> DataFrame:
    """gram, around, before, after for the classes of one anchor around which some string repeats."""
    spark = contexts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shape = "gram long, around long, before int, after int"
    bucket = ["key", "low", "high"]
    now, out = contexts, None
    while True:
        if out is not None:
            # Rows of a bucket that agree in all bytes of their half: every string of it repeats. One of them goes on, as a partner for others.
            same = now.filter("whole IS NOT NULL").groupBy(*bucket, "whole").agg(F.count(F.lit(1)).alias("alike"), F.min(F.struct("gram", "around")).alias("one"))
            marked = now.join(stored(same.filter("alike > 1"), "alike"), [*bucket, "whole"], "left")
            sure = marked.filter("alike > 1 AND single").select("gram", "around", F.col("high").alias("before"), (LENGTH - F.col("low")).alias("after"))
            out = out.unionByName(stored(sure, "sure"))
            now = stored(marked.filter("alike IS NULL OR (gram = one.gram AND around = one.around)")
                         .withColumn("single", F.col("single") & F.col("alike").isNull()).select(*contexts.columns), "left")
        sizes = now.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members"), F.max("single").alias("open")).filter("members > 1 AND open")
        sizes = stored(sizes, "buckets")
        rows = now.join(sizes, bucket)
        small = (rows.filter(f"members <= {BUCKET} AND low < high").select(*now.columns).repartition(parts, *bucket).sortWithinPartitions(*bucket)
                 .mapInArrow(_settled, shape))
        # A bucket of single strings with two members or more: they repeat.
        done = rows.filter("low = high AND single").select("gram", "around", F.col("low").alias("before"), (LENGTH - F.col("low")).alias("after"))
        found = stored(small.unionByName(done), "settled")
        out = found if out is None else out.unionByName(found)
        if not sizes.filter(f"members > {BUCKET} AND low < high").limit(1).count():
            return out.groupBy("gram", "around").agg(F.max("before").alias("before"), F.max("after").alias("after"))
        large = rows.filter(f"members > {BUCKET} AND low < high").select(*now.columns)
        now = stored(large.mapInArrow(_halved, _CONTEXT), "halved")


def runs(intervals: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs that the (start, end) rows cover within 0..size."""
    if not len(intervals):
        return []
    spans = np.clip(intervals[np.argsort(intervals[:, 0], kind="stable")], 0, size)
    reach = np.maximum.accumulate(spans[:, 1])
    fresh = np.r_[True, spans[1:, 0] > reach[:-1]]
    begins = np.flatnonzero(fresh)
    return list(zip(spans[begins, 0].tolist(), reach[np.r_[begins[1:] - 1, len(spans) - 1]].tolist()))


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, covered): the texts as bytes, and doc_id, mark, spans array<struct<start, end>> of those with repeated strings."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    repeated = docs.groupBy(doc_id).count().filter("count > 1").limit(1).count() > 0
    # Rows that repeat a doc_id are told apart by their texts; rows equal in both are covered alike.
    mark = F.xxhash64(raw) if repeated else F.lit(0).cast("long")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), mark.alias("mark"), raw.alias("raw"))
    found = stored(_anchored(texts), "anchors")
    buckets = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("low"), F.max("around").alias("high"))
    buckets = stored(buckets.filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("several")), "buckets")
    there = stored(found.join(buckets, "gram"), "repeated")
    drop_stored(found)
    several = there.filter("several")
    classes = stored(several.groupBy("gram", "around").agg((F.count(F.lit(1)) == 1).alias("single"), F.min(F.struct("doc_id", "mark", "pos")).alias("at")),
                     "classes")
    contexts = stored(_contexts(texts, classes), "contexts")
    partly = _refined(contexts)
    wide = [F.lit(LENGTH - GRAM).alias("before"), F.lit(LENGTH).alias("after")]
    by_class = stored(classes.filter("NOT single").select("gram", "around", *wide).unionByName(partly), "covered")
    place = ["doc_id", "mark", "pos", "before", "after"]
    cover = there.filter("NOT several").select("doc_id", "mark", "pos", *wide).unionByName(several.join(by_class, ["gram", "around"]).select(*place))
    span = F.struct((F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + F.col("after")).alias("end"))
    return texts, cover.groupBy("doc_id", "mark").agg(F.collect_list(span).alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes; NULL without ``with_text``) of each row.

    Removed is each byte covered by a string of LENGTH bytes that also starts anywhere else in the table, the same text
    included, judged on the texts as given. NULL counts as empty; texts shorter than LENGTH lose nothing; repeated rows
    are copies of each other; an empty table gives no rows. Other columns are not looked at. Runs when called.
    """
    texts, covered = repeated_runs(docs, doc_id, text)
    covered = stored(covered.select(F.col("doc_id").alias("of"), F.col("mark").alias("marked"), "spans"), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests, rest = [], [], [], [], []
            for raw, found in zip(batch.column("raw").to_pylist(), batch.column("spans")):
                flat = found.values.flatten() if found.is_valid else None
                gone = runs(np.stack([x.to_numpy(zero_copy_only=False) for x in flat], axis=1), len(raw)) if flat else []
                kept, at = [], 0
                for start, end in gone:
                    kept.append(raw[at:start])
                    at = end
                kept = b"".join([*kept, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept))
                spans.append(len(gone))
                digests.append(hashlib.sha256(kept).hexdigest())
                rest.append(kept if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(rest, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = texts.join(covered, texts["doc_id"].eqNullSafe(covered["of"]) & (texts["mark"] == covered["marked"]), "left")
    return joined.select("doc_id", "raw", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
