"""SimHash near-duplicates by multi-index hashing.

64-bit fingerprints within three bits of each other agree in one of their two halves up to one bit. Every
distinct fingerprint is stored under both halves and visits the keys one bit away from them, so all pairs
within three bits meet under some key; complete distances are then verified. Under a key no pair is written:
each task joins what it verifies with union-find and emits a spanning forest of each key's links. A key with many
fingerprints is split by parts of the other half first, which bounds what can meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.common import stored
from lodestep.llm.components import components

DISTANCE = 3
SHINGLE = 3
SEED = 42
#: Keys with more stored fingerprints than this, and the keys these visit, are split by 16-bit parts of the other half;
#: what then shares a key agrees in 48 bits but for two flips, so it is bounded whatever the size of the corpus.
SPLIT_ABOVE = 2_000
_BLOCK = 1 << 20  # pairs compared at a time
_ROWS = 100_000  # rows of whole keys verified at a time


def fingerprint(raw: bytes | None, width: int = SHINGLE) -> int:
    """SimHash of a text in UTF-8: majority of the bits of XXH64 over its word shingles, repeats included."""
    import xxhash

    tokens = (raw or b"").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not tokens:
        return 0
    if len(tokens) <= width:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(width)]))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row for each row; fp holds the 64 bits as a signed long. NULL and wordless texts give 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column("raw").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw")).mapInArrow(compute, "doc_id long, fp long")


def _flips(value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of the visits: each value with one of its set bits cleared. Of two values one bit apart the larger visits the smaller."""
    rows, keys = [], []
    for b in range(bits):
        has = np.flatnonzero(value >> np.uint64(b) & np.uint64(1))
        rows.append(has)
        keys.append(value[has] ^ np.uint64(1 << b))
    return np.concatenate(rows), np.concatenate(keys)


def _ball(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, keys and stored-flags of a segment: its own key, and its visits."""
    rows, keys = _flips(values, bits)
    own = np.arange(len(values))
    return np.concatenate([own, rows]), np.concatenate([values, keys]), np.concatenate([np.ones(len(values), bool), np.zeros(len(rows), bool)])


def _emit(*columns) -> pa.RecordBatch:
    names = ["half", "key", "sub", "fp", "owner"]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fingerprint under the ball of both its halves."""
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for half in (0, 1):
            rows, keys, owner = _ball(fp >> np.uint64(32) if half else fp & np.uint64(0xFFFFFFFF), 32)
            yield _emit(np.full(len(rows), half, np.int32), keys.view(np.int64), np.full(len(rows), -1, np.int64), fp[rows].view(np.int64), owner)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of crowded keys under the ball of both 16-bit parts of the half that is not the key."""
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        half = batch.column("half").to_numpy(zero_copy_only=False)
        other = np.where(half == 1, fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32))
        key, owner = batch.column("key").to_numpy(zero_copy_only=False), batch.column("owner").to_numpy(zero_copy_only=False)
        for part in (0, 1):
            rows, keys, _ = _ball(other >> np.uint64(16) if part else other & np.uint64(0xFFFF), 16)
            yield _emit(half[rows], key[rows], (keys | np.uint64(part << 16)).view(np.int64), fp[rows].view(np.int64), owner[rows])


def _forest(mine: np.ndarray, everyone: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between the fingerprints stored under a key and all that visit it."""
    nodes = np.unique(everyone)
    where = np.unique(np.searchsorted(nodes, mine))
    label = np.arange(len(nodes))
    out = []
    step = max(1, _BLOCK // len(nodes))
    for i in range(0, len(where), step):
        rows = where[i:i + step]
        near = np.bitwise_count(nodes[rows, None] ^ nodes[None, :]) <= distance
        for row, close in zip(rows, near):
            there = np.flatnonzero(close)
            groups, first = np.unique(label[there], return_index=True)
            if len(groups) > 1:
                out += [(nodes[row], nodes[there[f]]) for g, f in zip(groups, first) if g != label[row]]
                label[np.isin(label, groups)] = groups[0]
    return out


def _visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys and the keys their fingerprints visit."""
    for batch in batches:
        rows, keys, _ = _ball(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64), 32)
        half = batch.column("half").to_numpy(zero_copy_only=False)[rows]
        yield pa.RecordBatch.from_arrays([pa.array(half), pa.array(keys.view(np.int64))], ["half", "key"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the keys of a sorted partition; a key may go on in the next batch."""

    def solve(key: np.ndarray, fp: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        # keys with one row, or with visitors only, have no link to verify
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(key)]
        owners = np.add.reduceat(owner.astype(np.int64), starts)
        links = []
        two = (ends - starts == 2) & (owners > 0)
        a, b = fp[starts[two]], fp[starts[two] + 1]
        near = (np.bitwise_count(a ^ b) <= DISTANCE) & (a != b)
        pairs = np.stack([a[near], b[near]], axis=1)
        for s, e in zip(starts[(ends - starts > 2) & (owners > 0)], ends[(ends - starts > 2) & (owners > 0)]):
            links += _forest(fp[s:e][owner[s:e]], fp[s:e], DISTANCE)
        if links:
            pairs = np.concatenate([pairs, np.array(links, np.uint64)])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], ["u", "v"])

    def columns(batch):
        key = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("half", "key", "sub")], axis=1)
        return key, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), batch.column("owner").to_numpy(zero_copy_only=False)

    held: list[tuple] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(columns(batch))
        size += batch.num_rows
        if size < _ROWS:
            continue
        key, fp, owner = (np.concatenate(x) for x in zip(*held))
        changes = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        cut = changes[-1] if len(changes) else 0
        if cut:
            yield solve(key[:cut], fp[:cut], owner[:cut])
        held = [(key[cut:], fp[cut:], owner[cut:])]
        size = len(fp) - cut
    if held:
        yield solve(*(np.concatenate(x) for x in zip(*held)))


def links(prints: DataFrame, unique: bool = False) -> DataFrame:
    """(u, v) between distinct fingerprints (column fp) at most three bits apart, enough of them to connect all that are linked.

    ``unique``: no fingerprint is repeated.
    """
    distinct = prints.select("fp") if unique else prints.select("fp").distinct()
    halves = distinct.select(F.explode(F.array(*[F.struct(F.lit(h).alias("half"), k.alias("key")) for h, k in (
        (0, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))), (1, F.shiftrightunsigned("fp", 32)))])).alias("x"))
    full = halves.groupBy("x.half", "x.key").count().filter(F.col("count") > SPLIT_ABOVE).select("half", "key")
    probes = distinct.mapInArrow(_probes, "half int, key long, sub long, fp long, owner boolean")
    full = stored(full, "full")
    if full.count():
        crowded = stored(full.mapInArrow(_visited, "half int, key long").distinct(), "crowded")
        probes = stored(probes, "probes")
        many = probes.join(crowded, ["half", "key"]).select("half", "key", "sub", "fp", "owner").mapInArrow(_split, probes.schema)
        probes = probes.join(crowded, ["half", "key"], "left_anti").select("half", "key", "sub", "fp", "owner").unionByName(many)
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (probes.repartition(parts, "half", "key", "sub").sortWithinPartitions("half", "key", "sub")
            .mapInArrow(_verify, "u long, v long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id (least doc_id it is linked to, itself included) of each row.

    NULL, empty and wordless texts share fingerprint zero and are linked like any other. A NULL doc_id is no
    component's least unless its component has no other; repeated rows fall into one component. Other columns are not looked at.
    """
    prints = stored(fingerprints(docs, doc_id, text), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    linked = components(links(classes, unique=True))  # over fingerprints as numbers
    named = stored(classes.join(linked, classes["fp"] == linked["node"], "left")
                   .select("fp", "least", F.coalesce("component", "fp").alias("component")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = named.join(least, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the least doc_id of each component, with all its columns.

    Rows that share a doc_id are one document: they stay together if one of them does, so no component is lost.
    """
    kept = near_duplicates(docs, doc_id, text).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept_id"))
    return docs.join(kept, docs[doc_id].eqNullSafe(kept["_kept_id"]), "left_semi")
