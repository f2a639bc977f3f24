"""Near-duplicate paragraphs by MinHash banding, verified exactly and clustered.

A paragraph is cut by content, not by line: texts are cut where the hash of a few words is least in its neighbourhood, so a passage is cut in
the same places wherever it stands and however it is wrapped. Chunks that occur again, side by side in a document (one
changed chunk between them is bridged), make a paragraph. Lines, blocks between blank lines and whole texts are paragraphs too, whatever chunks they
share: a few least hashes of each tell which may have their like elsewhere. Only these paragraphs are signed and banded. Equal word sequences fall into one class first, so
only different paragraphs are compared. Under a band key no pairs are written out: each paragraph is verified against a leader of the
key, a different one in each band, and what these links already connect needs no further look. The keys whose paragraphs are still apart are
then verified in tasks, block against block of their paragraphs, and each pair of blocks gives a spanning forest of its
links; so no link between different texts that the bands bring together is lost, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestep.llm.common import drop_stored, per_worker, stored
from lodestep.llm.components import components

SIMILARITY, SHINGLE = 0.8, 5
#: A cut is where the hash of GRAM words is least among the REACH ones before and after it; chunks have about 2 * REACH + 1 words.
GRAM, REACH = 3, 8
#: Words of repeated chunks from which a paragraph counts. A passage of 50 words has that many in 98 of 100 cases.
MIN_WORDS = 20
RECALL, MOST_HASHES = 0.999, 96
#: Keys of a line, block or text, each of two least hashes; similar ones share none of them in one of 9,800 cases.
PROBES = 9
#: Paragraphs of a key compared with each other at a time.
BLOCK = 256
#: Shingles compared at a time, and held before a task verifies its keys; bytes of a text read at once.
COLUMNS, HELD, STRETCH = 16_384, 4_000_000, 1 << 22

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9))
_INVERSES = {m: np.uint64(pow(int(m), -1, 1 << 64)) for m in (_M1, _M3)}
#: Powers that a worker keeps for each base; longer texts than these compute their own.
KEPT_POWERS = 1 << 16
_LETTERS = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])


def tune(similarity: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective banding that finds a pair at ``similarity`` with probability ``recall`` or more."""
    best = None
    for rows in range(1, most + 1):
        for bands in range(1, most // rows + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                best = bands, rows
                break
    if best is None:
        raise ValueError("no banding with so few hashes reaches the recall")
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    kept = per_worker(("powers", int(base)), lambda: _new_powers(base, KEPT_POWERS)) if n <= KEPT_POWERS else _new_powers(base, n)
    return kept[:n]


def _new_powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def tokens(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words of a text in UTF-8, A-Z in lower case; positions in bytes. Read in stretches that end between words."""
    letters, blank, inverse = _LETTERS, _BLANK, _INVERSES[_M1]
    found, at = [], 0
    low = raw.lower()
    while at < len(low):
        part = np.frombuffer(low, np.uint8, min(STRETCH, len(low) - at), at)
        space = blank[part]
        if at + len(part) < len(low) and space.any():  # the word that is cut off is read with the next stretch
            part = part[:len(part) - int(np.argmax(space[::-1]))]
        elif at + len(part) < len(low):  # a word longer than a stretch
            rest = np.frombuffer(low, np.uint8, offset=at)
            gaps = np.flatnonzero(blank[rest])
            part = rest[:int(gaps[0]) + 1] if len(gaps) else rest
        space = blank[part]
        edge = np.diff(np.concatenate([[1], space.view(np.int8), [1]]))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(letters[part] * _powers(_M1, len(part)), out=sums[1:])
        value = (sums[end] - sums[start]) * _powers(inverse, len(part) + 1)[start]
        found.append((_mixed(value + (end - start).astype(np.uint64)), start + at, end + at))
        at += len(part)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` words, or of all where there are fewer."""
    width = min(width, len(words))
    out = np.zeros(max(len(words) - width + 1, 0) if width else 0, np.uint64)
    for j in range(width):
        out = out * _M1 + words[j:len(words) - width + 1 + j]
    return _mixed(out)


def cuts(words: np.ndarray) -> np.ndarray:
    """Where the chunks of a text begin, the end of the text included."""
    gram = grams(words, GRAM)
    edge = np.full(REACH, np.uint64(2**64 - 1))
    least, width = np.concatenate([edge, gram, edge]), 1
    while width < 2 * REACH + 1:  # least of so many from here on
        more = min(width, 2 * REACH + 1 - width)
        least, width = np.minimum(least[:-more], least[more:]), width + more
    inner = np.flatnonzero(gram == least)
    return np.concatenate([[0], inner[inner > 0], [len(words)]])


def shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles; fewer words are one shingle."""
    return np.unique(grams(words, width))


def standing(raw: bytes, start: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every line, block between blank lines and whole text of ``least`` words or more; ``start``: bytes where words begin."""
    n = len(start)
    line = np.searchsorted(np.flatnonzero(np.frombuffer(raw, np.uint8) == 10), start)
    gap = np.diff(line)
    edges = [np.concatenate([[0], np.flatnonzero(gap >= lines) + 1, [n]]) for lines in (1, 2, n + len(raw))]
    place = np.unique(np.concatenate([e[:-1] * (n + 1) + e[1:] for e in edges]))
    a, b = place // (n + 1), place % (n + 1)
    return a[b - a >= least], b[b - a >= least]


def _probes(gram: np.ndarray, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Keys from least hashes, two each, of the shingles from a to b, a row for each."""
    ends = np.minimum(np.stack([a, b], axis=1), len(gram)).ravel()
    least, mixed = np.empty((len(times), len(a)), np.uint64), np.zeros(len(gram) + 1, np.uint64)
    for i, by in enumerate(times):
        np.multiply(gram, by, out=mixed[:-1])
        least[i] = np.minimum.reduceat(mixed, ends)[::2]
    return _mixed((_mixed(least[::2]) + least[1::2]) * _M3 + np.arange(len(times) // 2, dtype=np.uint64)[:, None]).T


def _chunks(docs: DataFrame, doc_id: str, text: str, least: int | None = None) -> DataFrame:
    """A row for each chunk: doc_id, row, mark (hash of the text), number, start, end, words, the hash of its words in two halves, whole, probes.

    ``row`` counts the chunks of the partition before the text, so row + number tells chunks apart and orders them as row and number do.
    With ``least`` there is also a row for each line, block and text of as many words, with whole and its probes; number is that of the chunk it begins in.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = ["doc_id", "row", "mark", "number", "start", "end", "words", "high", "low", "whole", "probes"]
        times = np.random.default_rng(13).integers(0, 1 << 63, 2 * PROBES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        before = 0
        for batch in batches:
            held: list[list] = []
            texts, sizes, gram, spans, begun = [], [], [], [], 0
            for i, (row, value) in enumerate(zip(batch.column("row").to_pylist(), batch.column("raw"))):
                raw = value.as_py() or b""
                words, start, end = tokens(raw)
                if not len(words):
                    continue
                edge = cuts(words)
                a, b = edge[:-1], edge[1:]
                number = np.arange(len(a))
                units = 0
                if least is not None:
                    first, last = standing(raw, start, least)
                    units = len(first)
                    number = np.concatenate([number, np.searchsorted(a, first, side="right") - 1])
                    if units:
                        gram.append(grams(words, SHINGLE))
                        spans.append(np.stack([first, np.maximum(last - SHINGLE, first) + 1]) + begun)
                        begun += len(gram[-1])
                    a, b = np.concatenate([a, first]), np.concatenate([b, last])
                halves = []
                for base in (_M1, _M3):
                    sums = np.zeros(len(words) + 1, np.uint64)
                    np.cumsum(_mixed(words + base) * _powers(base, len(words)), out=sums[1:])
                    halves.append(_mixed((sums[b] - sums[a]) * _powers(_INVERSES[base], len(words))[a]).view(np.int64))
                n = len(a)
                row = (row >> 33 << 33) + before  # Spark numbers rows by partition, in the upper bits
                before += n - units
                sizes.append(n)
                texts.append((i, row, np.uint64(xxhash.xxh3_64_intdigest(raw)).view(np.int64)))
                held.append([number, start[a], end[b - 1], b - a, *halves, np.arange(n) >= n - units])
            if held:
                place, *of_text = np.repeat(np.array(texts, np.int64), sizes, axis=0).T
                whole = np.concatenate([h[6] for h in held])
                probes = _probes(np.concatenate(gram), *np.concatenate(spans, axis=1), times).ravel() if spans else np.zeros(0, np.uint64)
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(whole * PROBES)]), pa.int32()), pa.array(probes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(place)), *[pa.array(x, pa.int64()) for x in of_text],
                                                  *[pa.array(np.concatenate([h[i] for h in held]), pa.int64()) for i in range(6)],
                                                  pa.array(whole), listed], names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("binary").alias("raw"))
    return rows.mapInArrow(cut, "doc_id long, row long, mark long, number long, start long, end long, words long, high long, low long, whole boolean, "
                                "probes array<long>")


def _stretches(chunks: DataFrame, least: int) -> DataFrame:
    """A row for each paragraph: doc_id, row, mark, number (of its first chunk), start, end, words (in repeated chunks), first (whether a
    chunk occurs here first).

    Chunks that occur again are neighbours if at most one other chunk stands between them.
    """
    at = F.col("row") + F.col("number")  # one number, so that its minimum is kept in a hash table and not by sorting
    classes = stored(chunks.groupBy("high", "low").agg(F.min(at).alias("origin"), F.count(F.lit(1)).alias("members")).filter("members > 1")
                     .drop("members"), "repeated")
    again = stored(chunks.join(classes, ["high", "low"]).select("doc_id", "row", "mark", "number", "start", "end", "words", (F.col("origin") == at).alias("first")),
                   "again")
    line = Window.partitionBy("row").orderBy("number")
    opens = F.coalesce((F.col("number") - F.lag("number").over(line) > 2).cast("int"), F.lit(1))
    island = F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0))
    found = (again.withColumn("opens", opens).withColumn("island", island).groupBy("doc_id", "row", "mark", "island")
             .agg(F.min("number").alias("number"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"),
                  F.max("first").alias("first")).filter(F.col("words") >= least).drop("island"))
    out = stored(found, "stretches")
    drop_stored(classes)
    drop_stored(again)
    return out


def _candidates(units: DataFrame) -> DataFrame:
    """The rows of lines, blocks and texts, in the form of stretches, that occur again or share a probe with another one they do not overlap.

    Most have no like and are dropped before they are signed.
    """
    probe = F.explode("probes").alias("probe")
    common = stored(units.select("high", probe).groupBy("probe").agg(F.min("high").alias("a"), F.max("high").alias("b")).filter("a < b").select("probe"), "common")
    keyed = stored(units.select("high", "low", "row", "start", "end", probe).join(common, "probe"), "keyed")
    # two places of a key lie apart if they are in different texts, or one begins where another has ended
    shared = stored(keyed.groupBy("probe").agg(F.min("row").alias("a"), F.max("row").alias("b"), F.max("start").alias("c"), F.min("end").alias("d"))
                    .filter("a < b OR c >= d").select("probe"), "probes")
    again = units.groupBy("high", "low").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("high", "low")
    chosen = stored(keyed.join(shared, "probe").select("high", "low").unionByName(again).distinct(), "chosen")
    out = stored(units.join(chosen, ["high", "low"]).select("doc_id", "row", "mark", "number", "start", "end", "words", F.lit(True).alias("first")), "units")
    for done in (common, keyed, shared, chosen):
        drop_stored(done)
    return out


def _told_apart(cluster: DataFrame) -> DataFrame:
    """``cluster`` with one row where paragraphs of a component overlap in a text, as a line and the text it nearly fills do.

    Stretches stay. Of lines, blocks and texts without a stretch the outermost stay that do not hold two others side by side.
    """
    columns = [c for c in cluster.columns if c not in ("component_id", "row")]
    grouped = cluster.groupBy("component_id", "row").agg(F.collect_list(F.struct(*columns)).alias("spots"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = batch.column("spots")
            flat, size = spots.flatten(), np.diff(spots.offsets.to_numpy())
            whole, start, end = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("whole", "start", "end"))
            ends = np.cumsum(size)
            stays = [low + outermost(whole[low:low + n], start[low:low + n], end[low:low + n]) if n > 1 else [low] for low, n in zip(ends - size, size)]
            at = np.concatenate(stays) if stays else np.zeros(0, np.int64)
            group = pa.array(np.repeat(np.arange(len(size)), [len(x) for x in stays]))
            taken = flat.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([batch.column("component_id").take(group), batch.column("row").take(group),
                                              *[taken.field(c) for c in columns]], ["component_id", "row", *columns])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cluster.schema if f.name in columns)
    return grouped.mapInArrow(choose, f"component_id long, row long, {kinds}")


def outermost(whole: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of the paragraphs of one text and component stay, as numbers: see :func:`_told_apart`. Units (whole) lie apart or one inside the other."""
    first, last = np.sort(start[~whole]), np.sort(end[~whole])
    units = np.flatnonzero(whole & (np.searchsorted(first, end, side="left") <= np.searchsorted(last, start, side="right")))
    if len(units):
        units = units[np.lexsort((-end[units], start[units]))]
        a, b = start[units], end[units]
        leaf = np.append(a[1:] >= b[:-1], True)  # holds no other
        single = np.searchsorted(a[leaf], b) - np.searchsorted(a[leaf], a) == 1
        units, a, b = units[single], a[single], b[single]
        units = units[a >= np.maximum.accumulate(np.append(-1, b[:-1]))]
    return np.concatenate([np.flatnonzero(~whole), units])


def _signed(docs: DataFrame, stretches: DataFrame, doc_id: str, text: str, bands: int, rows: int) -> DataFrame:
    """mark, start, end, content (128-bit hash of the words), n (shingles), shingles and band keys of each paragraph of a text.

    One shingle has no bands: such a paragraph is similar to those of its class alone. Of equal texts those under the least doc_id are read.
    """
    wanted = (stretches.groupBy("mark").agg(F.min("doc_id").alias("of"), F.collect_set(F.struct("start", "end")).alias("ranges"))
              .groupBy("of").agg(F.collect_list(F.struct("mark", "ranges")).alias("marks")))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        signer = Signer(bands, rows)
        names = ["mark", "start", "end", "content", "n", "shingles", "bands"]
        for batch in batches:
            found = []
            for raw, marks in zip(batch.column("raw"), batch.column("marks").to_pylist()):
                raw = raw.as_py()
                mark = int(np.uint64(xxhash.xxh3_64_intdigest(raw)).view(np.int64))
                for m in marks:  # rows that repeat a doc_id can hold other texts
                    if m["mark"] == mark:
                        ranges = [(r["start"], r["end"]) for r in m["ranges"]]
                        low = min(a for a, _ in ranges)
                        every, begin, _ = tokens(raw[low:max(b for _, b in ranges)])
                        for (a, b), p, q in zip(ranges, *np.searchsorted(begin, np.array(ranges).T - low)):
                            words = every[p:q]
                            found.append((mark, a, b, xxhash.xxh3_128_digest(words.tobytes()), shingles(words)))
            if found:
                sets = [f[4] for f in found]
                several = [x for x in sets if len(x) > 1]
                keys = iter(signer.keys(several).view(np.int64)) if several else iter(())
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([f[i] for f in found], pa.int64()) for i in range(3)], pa.array([f[3] for f in found], pa.binary()),
                     pa.array([len(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                     pa.array([next(keys) if len(x) > 1 else [] for x in sets], pa.list_(pa.int64()))], names)

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    return (texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["of"])).select("raw", "marks")
            .mapInArrow(sign, "mark long, start long, end long, content binary, n long, shingles array<long>, bands array<long>"))


class Signer:
    """Band keys of shingle sets by ``bands`` x ``rows`` multiplicative hashes."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(11)
        self.bands, self.rows = bands, rows
        self.times = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of band keys for each set."""
        flat = np.concatenate(sets)
        first = np.cumsum([0, *map(len, sets[:-1])])
        out = np.zeros((len(sets), self.bands), np.uint64)
        mixed = np.empty_like(flat)
        for i, times in enumerate(self.times):
            np.multiply(flat, times, out=mixed)
            band = i // self.rows
            out[:, band] = (out[:, band] ^ np.minimum.reduceat(mixed, first)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band)
            out[:, band] ^= out[:, band] >> np.uint64(29)
        return out


PLACES = ["first_mark", "last_mark", "last_start", "first_end"]


def _places(names: tuple[str, ...] = tuple(PLACES)) -> list[Column]:
    """Extremes of the places (mark, start, end) of paragraphs, or of such extremes, from which follows whether two lie apart."""
    return [f(c).alias(place) for f, c, place in zip((F.min, F.max, F.max, F.min), names, PLACES)]


def _alike(size_a: Column, size_b: Column, similarity: float) -> Column:
    """Whether sets of these sizes can reach the similarity at all."""
    return F.least(size_a, size_b) >= F.lit(similarity) * F.greatest(size_a, size_b) - 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose Jaccard similarity reaches the threshold."""
    a, b = sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return (pairs.distinct().join(a, "u").join(b, "v")
            .filter(common >= F.lit(similarity) * (F.size("a") + F.size("b") - common) - 1e-9).select("u", "v"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def links(classes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(u, v) links between classes (id, n, bands, places) that connect all that the bands bring together and that are similar."""
    keyed = classes.select("id", "n", *PLACES, F.posexplode("bands").alias("band", "key"))
    # a key whose paragraphs all overlap in one text, as a line and its text do, tells of no other paragraph
    shared = (keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"), *_places()).filter("members > 1")
              .filter("first_mark < last_mark OR last_start >= first_end").select("band", "key"))
    rows = stored(keyed.drop(*PLACES).join(shared, ["band", "key"]), "banded")
    # A leader in each key, chosen by a hash that differs between bands, against every other member.
    order = F.struct(F.xxhash64("id", "band"), F.col("id"), F.col("n"))
    leaders = stored(rows.groupBy("band", "key").agg(F.min(order).alias("first")).select(
        "band", "key", F.col("first.id").alias("leader"), F.col("first.n").alias("m")), "leaders")
    others = stored(rows.join(leaders, ["band", "key"]).filter(F.col("id") != F.col("leader")), "others")
    drop_stored(rows)
    drop_stored(leaders)
    pairs = others.filter(_alike(F.col("n"), F.col("m"), similarity))
    found = stored(_verified(pairs.select(*_pair("id", "leader")), sets, similarity), "verified")
    # a leader has met every member of its key: only the others can still have links
    apart = _still_apart(others, found)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drop_stored(others)
    sizes = stored(apart.groupBy("band", "key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (apart.join(sizes, ["band", "key"]).join(sets, "id").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "component", "shingles"))
    group = ["band", "key", "low", "high"]
    blocks = stored(dealt.repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(_block_links(similarity), "u long, v long"), "forests")
    drop_stored(apart)
    drop_stored(sizes)
    return found.unionByName(blocks)


def _block_links(similarity: float):
    """Links of sorted rows (band, key, low, high, ...): a spanning forest of each pair of blocks."""

    def forest(first: np.ndarray, ids: np.ndarray, component: np.ndarray, flat: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
        here = np.flatnonzero(first)  # rows of the lower block, against all rows or, between blocks, the others
        there = np.flatnonzero(~first) if not first.all() else here
        word, at, often = np.unique(flat, return_inverse=True, return_counts=True)
        common = often[at] > 1  # a shingle that one row has is in no common part
        row, column = np.repeat(np.arange(len(ids)), size)[common], (np.cumsum(often > 1) - 1)[at[common]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(here), len(there)), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            some = slice(*np.searchsorted(column, (low, low + COLUMNS)))
            table = np.zeros((len(ids), min(COLUMNS, int(column[-1]) + 1 - low)), np.float32)
            table[row[some], column[some] - low] = 1
            both += table[here] @ table[there].T
        near = both >= similarity * (size[here][:, None] + size[there][None, :] - both) - 1e-6
        _, label = np.unique(component, return_inverse=True)
        out = []
        for i, close in zip(here, near):
            others = there[close]
            groups, where = np.unique(label[others], return_index=True)
            fresh = groups != label[i]
            if fresh.any():
                out += [(ids[i], ids[others[w]]) for w in where[fresh]]
                label[np.isin(label, groups[fresh])] = label[i]
        return out

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = values = 0

        def solve(table: pa.Table) -> pa.RecordBatch:
            key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("band", "key", "low", "high")], axis=1)
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            ids, component = table.column("id").to_numpy(), table.column("component").to_numpy()
            first = table.column("block").to_numpy() == key[:, 2]
            lists = table.column("shingles").combine_chunks()
            offset = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            out = []
            for a, b in zip(starts, np.r_[starts[1:], len(key)]):
                if b - a > 1:
                    out += forest(first[a:b], ids[a:b], component[a:b], flat[offset[a]:offset[b]], np.diff(offset[a:b + 1]))
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows, values = rows + batch.num_rows, values + len(batch.column("shingles").flatten())
            if rows < 20 * BLOCK and values < HELD:
                continue
            table = pa.Table.from_batches(held)
            key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("band", "key", "low", "high")], axis=1)
            changes = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            cut = int(changes[-1]) if len(changes) else 0
            if cut:
                yield solve(table.slice(0, cut).combine_chunks())
            held, rows = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
            values = sum(len(b.column("shingles").flatten()) for b in held)
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return verify


def _still_apart(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The members of keys whose members the links found so far do not all connect, with their components."""
    linked = components(found)
    named = stored(rows.join(linked, rows["id"] == linked["node"], "left")
                   .select("band", "key", "id", "n", F.coalesce("component", "id").alias("component")), "named")
    apart = named.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    out = stored(named.join(apart.select("band", "key"), ["band", "key"]), "apart")
    drop_stored(named)
    return out


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, least: int = MIN_WORDS) -> DataFrame:
    """Every paragraph of chunks that occur again: doc_id, paragraph (number of its first chunk), start, end (bytes, end exclusive), words (in
    repeated chunks), component_id, members, keep_doc_id, keep_paragraph, removed.

    Paragraphs that are similar form a component, in which the one of the least doc_id (then place) stays and the others are removed. A
    paragraph without its like as a whole (its chunks occur in longer, shorter or several other paragraphs) is a component of its own (members 1) and
    is removed if each of its repeated chunks occurs earlier. Words are compared after lower-casing A-Z; ``least`` words in repeated
    chunks make a paragraph. Chunks that only repeat inside one text count too. NULL and empty texts have no paragraphs, repeated rows are copies of each
    other, an empty table gives no rows; a NULL doc_id stays last. Other columns are not looked at. Runs when called.
    """
    return _clustered(docs, doc_id, text, similarity, least, False)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, least: int = MIN_WORDS) -> DataFrame:
    """The paragraphs of :func:`repeated`, and every line, block between blank lines and whole text of ``least`` words or more that is similar to
    another paragraph it does not overlap, whether or not they have a chunk in common; words of these counts all their words.

    Paragraphs of one component that overlap in a text are one paragraph: the stretch of repeated chunks, else the outermost.
    Those of different components can lie inside each other. Columns and rules are otherwise the same. Runs when called.
    """
    return _clustered(docs, doc_id, text, similarity, least, True)


def _clustered(docs: DataFrame, doc_id: str, text: str, similarity: float, least: int, whole: bool) -> DataFrame:
    bands, rows = tune(similarity)
    chunks = stored(_chunks(docs, doc_id, text, least if whole else None), "chunks")
    stretches = _stretches(chunks.filter("NOT whole"), least)
    if whole:
        units = _candidates(chunks.filter("whole"))
        more = units.join(stretches.select("row", "start", "end"), ["row", "start", "end"], "left_anti")
        both = stored(stretches.withColumn("whole", F.lit(False)).unionByName(more.withColumn("whole", F.lit(True))), "paragraphs")
        drop_stored(stretches)
        drop_stored(units)
        stretches = both
    else:
        stretches = stretches.withColumn("whole", F.lit(False))
    drop_stored(chunks)
    signed = stored(_signed(docs, stretches, doc_id, text, bands, rows), "signed")
    classes = stored(signed.groupBy("content").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("shingles").alias("shingles"),
                                                       *_places(("mark", "mark", "start", "end")))
                     .withColumn("id", F.monotonically_increasing_id()), "classes")
    contents = stored(signed.select("mark", "start", "end", "content").distinct(), "contents")  # rows can repeat a doc_id and a text
    drop_stored(signed)
    joined = stored(components(links(classes.select("id", "n", "bands", *PLACES), classes.select("id", "shingles"), similarity)), "joined")
    of_class = stored(classes.join(joined, classes["id"] == joined["node"], "left")
                      .select("content", F.coalesce("component", "id").alias("component_id")), "named")
    named = stretches.join(contents, ["mark", "start", "end"]).join(of_class, "content").drop("content", "mark")
    cluster = stored(_told_apart(named) if whole else named, "clustered")
    place = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col("number"), F.col("row"), F.col("start")))
    kept = stored(cluster.groupBy("component_id").agg(place.alias("kept"), F.count(F.lit(1)).alias("members")), "kept")
    for done in (stretches, contents, classes, joined, of_class):
        drop_stored(done)
    stays = (F.col("row") == F.col("kept.row")) & (F.col("start") == F.col("kept.start"))
    return (cluster.join(kept, "component_id").filter("members > 1 OR NOT whole")
            .select("doc_id", F.col("number").alias("paragraph"), "start", "end", "words", "component_id", "members", F.col("kept.doc_id").alias("keep_doc_id"),
                    F.col("kept.number").alias("keep_paragraph"), F.when(F.col("members") > 1, ~stays).otherwise(~F.col("first")).alias("removed")))
