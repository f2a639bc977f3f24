"""Spelling variants: words one edit apart, found by probing generated edits against broadcast Bloom filters.

The vocabulary is counted with a combine step in every task. Filters of 64-bit blocks are made per word length, and a filter is split
into ranges of blocks, so that what is broadcast at once has a fixed bound; a larger vocabulary takes more rounds. Each word probes its
deletions and its replacements by a later letter (an insertion is the deletion of the other word), whose hashes follow from the
word's own. Only edits that the filters hold are spelled out and joined with the vocabulary, which removes false positives.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.common import stored

# Fixed values of the word rule.
RUN = "a-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, TYPO_EVERY, FORM_RATIO = 7, 2, 31, 10

#: Words of this length or longer share one class of filters.
LAST_CLASS = 64
#: Bits of a filter for each word, blocks in one part of a filter (8 bytes each), bytes broadcast at once.
BITS, PART_BLOCKS, BROADCAST_BYTES = 24, 1 << 18, 32 << 20
#: Characters of a text read at once; distinct words a task holds before it hands on their counts; places probed at once.
STRETCH, HELD, PROBED = 1_000_000, 200_000, 1 << 17
#: Words probed in one task; a word has hundreds of edits, so a file of words is far more work than its bytes say.
TASK_WORDS = 20_000

_RUNS = re.compile(f"[{RUN}]{{{MIN_LENGTH},}}")
_BREAK = re.compile(f"[^{RUN}]")
_FACTOR, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_WORD_BITS = 64


def _runs(text: str) -> Counter:
    """Runs of MIN_LENGTH letters or more with their counts, A-Z in lower case; a long text is read in stretches cut between runs."""
    if len(text) <= STRETCH:
        return Counter(_RUNS.findall(text.encode().lower().decode()))
    found, start = Counter(), 0
    low = text.encode().lower().decode()
    while start < len(low):
        cut = _BREAK.search(low, start + STRETCH)
        end = cut.start() if cut else len(low)
        found.update(_RUNS.findall(low[start:end]))
        start = end
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    crc32 = zlib.crc32
    held: dict[str, int] = {}

    def out():
        return pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())},
                                          schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            if not (text := text.as_py()):
                continue
            start = crc32(f"{'' if (name := doc_id.as_py()) is None else name}:".encode())
            for word, n in _runs(text).items():
                h = crc32(word.encode(), start)
                if h % TYPO_EVERY == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                    if len(word) < MIN_LENGTH:
                        continue
                held[word] = held.get(word, 0) + n
            if len(held) >= HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least MIN_LENGTH code points that occur ``min_count`` times or more in all texts.

    A run's hash with its document's id decides whether one of its letters is left out. NULL texts have no words, a NULL id is empty.
    """
    counts = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _letters() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(length: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.full(length, _FACTOR, np.uint64)]).cumprod(dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_MIX)
    return h ^ (h >> np.uint64(29))


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each mixed hash, of a filter of ``blocks``; its upper half decides."""
    return (((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _bits(h: np.ndarray) -> np.ndarray:
    """Five bits of a block, by the lower half of each mixed hash."""
    one, low = np.uint64(1), np.uint64(_WORD_BITS - 1)
    out = one << (h & low)
    for shift in (6, 12, 18, 24):
        out |= one << ((h >> np.uint64(shift)) & low)
    return out


def _matrix(words: list[str], length: int) -> np.ndarray:
    """The code points of words of one length, a row each; all are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        out.setdefault(len(word), []).append(i)
    return out


def _hashes(words: list[str]) -> np.ndarray:
    letters, out = _letters(), np.zeros(len(words), np.uint64)
    for length, rows in _by_length(words).items():
        codes = _matrix([words[i] for i in rows], length)
        out[rows] = _mixed((letters[codes] * _powers(length)[:length]).sum(1, dtype=np.uint64))
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _hashes(batch.column(0).to_pylist()).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["word", "n", "hash"])


def _filter(blocks: dict[int, int], part_blocks: int):
    """A function from the hashes of a part of a filter to its bits."""

    def build(key, table):
        size, part = key[0].as_py(), key[1].as_py()
        first = part * part_blocks
        h = table.column("hash").to_numpy().view(np.uint64)
        bits = np.zeros(min(part_blocks, blocks[size] - first), np.uint64)
        np.bitwise_or.at(bits, _block(h, blocks[size]) - first, _bits(h))
        return pa.table({"size": pa.array([size], pa.int32()), "part": pa.array([part], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    return build


def _probe(held, alphabet: np.ndarray, blocks: dict[int, int], part_blocks: int):
    """Edits of words that the broadcast parts of filters hold: (edit, word, n)."""

    def present(h, size, parts):
        """Where the parts of the filter of ``size`` hold mixed hashes."""
        at, found = _block(h, blocks[size]), []
        for part, raw in parts:
            bits = np.frombuffer(raw, np.uint64)
            first = part * part_blocks
            some = np.flatnonzero((at >= first) & (at < first + len(bits))) if len(bits) < blocks[size] else slice(None)
            own = bits[at[some] - first]
            likely = np.flatnonzero(own >> (h[some] & np.uint64(_WORD_BITS - 1)) & np.uint64(1))  # most fail at their first bit
            where = likely if isinstance(some, slice) else some[likely]
            want = _bits(h[where])
            found.append(where[own[likely] & want == want])
        return np.concatenate(found)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, filters = _letters(), held.value
        inverse = np.uint64(pow(_FACTOR, -1, 1 << 64))
        shape = pa.schema([("edit", pa.string()), ("word", pa.string()), ("n", pa.int64())])

        def edits(words, length):
            codes = _matrix(words, length)
            powers = _powers(length)[:length]
            parts = letters[codes] * powers
            whole = parts.sum(1, dtype=np.uint64)
            if (size := min(length - 1, LAST_CLASS)) in filters:
                before = np.cumsum(parts, 1, dtype=np.uint64)
                h = _mixed(((before - parts) + (whole[:, None] - before) * inverse).ravel())
                for j in present(h, size, filters[size]).tolist():
                    r, i = divmod(j, length)
                    if i == 0 or words[r][i] != words[r][i - 1]:  # of equal letters side by side the first
                        yield words[r][:i] + words[r][i + 1:], r
            if (size := min(length, LAST_CLASS)) in filters:
                rest, flat = (whole[:, None] - parts).ravel(), codes.ravel()
                weights = np.tile(powers, len(words))
                for letter in alphabet.tolist():
                    asked = np.flatnonzero(flat < letter)  # a pair is found from its smaller word
                    h = _mixed(rest[asked] + letters[letter] * weights[asked])
                    for j in asked[present(h, size, filters[size])].tolist():
                        r, i = divmod(j, length)
                        yield words[r][:i] + chr(letter) + words[r][i + 1:], r

        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, rows in _by_length(words).items():
                group = max(1, PROBED // length)
                for k in range(0, len(rows), group):
                    mine = rows[k:k + group]
                    found = list(edits([words[i] for i in mine], length))
                    if found:
                        yield pa.RecordBatch.from_pydict({"edit": [e for e, _ in found], "word": [words[mine[r]] for _, r in found],
                                                          "n": [counts[mine[r]] for _, r in found]}, schema=shape)

    return probe


def _rounds(parts: list[tuple[int, int]], blocks: dict[int, int], part_blocks: int, limit: int) -> list[list[tuple[int, int]]]:
    """The parts (length class, part) in groups of at most ``limit`` bytes, of one part at least."""
    out, room = [], 0
    for size, part in parts:
        need = min(part_blocks, blocks[size] - part * part_blocks) * _WORD_BITS // 8
        if need > room:
            out.append([])
            room = max(limit, need)
        out[-1].append((size, part))
        room -= need
    return out


def near_words(words: DataFrame, part_blocks: int = PART_BLOCKS, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of ``words`` (word, n) that differ by exactly one code point.

    Words are distinct, and of letters below U+0100. Filters have no false negatives and the join is exact, so no pair is lost and
    none is wrong. A word has at most some 1,900 possible neighbours of its length or shorter by one, so no key grows with the data.
    """
    spark = words.sparkSession
    hashed = stored(words.select("word", "n").mapInArrow(_hashed, "word string, n long, hash long")
                    .withColumn("size", F.least(F.length("word"), F.lit(LAST_CLASS))), "vocabulary")
    sizes = {r["size"]: r["n"] for r in hashed.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {size: max(1, n * BITS // _WORD_BITS) for size, n in sizes.items()}
    if not sizes:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    if max(blocks.values()) >= 1 << 31:
        raise ValueError("more than five billion words of one length")
    letters = hashed.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct().collect()
    alphabet = np.sort(np.array([ord(r["c"]) for r in letters], np.uint8))
    total = F.create_map(*[F.lit(x) for item in blocks.items() for x in item])[F.col("size")].cast("long")
    block = F.shiftrightunsigned(F.shiftrightunsigned("hash", 32) * total, 32)
    filters = stored(hashed.select("size", F.floor(block / part_blocks).alias("part"), "hash").groupBy("size", "part")
                     .applyInArrow(_filter(blocks, part_blocks), "size int, part long, bits binary"), "filters")
    names = sorted((r["size"], r["part"]) for r in filters.select("size", "part").collect())
    candidates = None
    for some in _rounds(names, blocks, part_blocks, limit):
        held: dict[int, list] = {}
        here = F.struct("size", "part").isin([F.struct(F.lit(s), F.lit(p).cast("long")) for s, p in some])
        for r in filters.filter(here).collect():
            held.setdefault(r["size"], []).append((r["part"], bytes(r["bits"])))
        near = {s for size in held for s in (size, size + 1)}
        tasks = -(-sum(n for size, n in sizes.items() if size in near) // TASK_WORDS)
        asked = hashed.filter(F.col("size").isin(near)).select("word", "n").repartition(tasks, "word")
        shared = spark.sparkContext.broadcast(held)
        found = stored(asked.mapInArrow(_probe(shared, alphabet, blocks, part_blocks), "edit string, word string, n long"), "positives")
        shared.unpersist()
        candidates = found if candidates is None else candidates.unionByName(found)
    exact = candidates.join(hashed.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
    return exact.select("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")).unionByName(
        exact.select(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per word of the vocabulary: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if that n is at least FORM_RATIO times the word's, else NULL;
    ``root`` follows forms to the last. Repeated rows count as often as they stand there; without words there are no rows.
    Other columns are not looked at.
    """
    words = stored(vocabulary(docs, doc_id, text), "words")
    near = near_words(words)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    form = F.col("best.less") * -1 >= F.col("n") * FORM_RATIO
    named = stored(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                           F.when(form, F.col("best.near")).alias("form"),
                                                           F.when(form, -F.col("best.less")).alias("form_n")), "forms")
    # Counts rise at least tenfold from form to form, so a chain has at most 18 links and five doublings reach its end.
    chain = named.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        chain = stored(chain, "roots")
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if chain.join(onward, "root", "left_semi").isEmpty():
            break
        chain = chain.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return (named.join(chain, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
