"""Packing, shards and segmentations."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodestep.llm import packing, pieces, shards
from lodestep.llm.tokens import encoder
from lodestep.session import new_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(BPE)


def test_ids_are_those_of_the_library(texts, bpe):
    encode = encoder(BPE)
    odd = ["", " ", "  x\r\n\t ", "a<|endoftext|>b", "\x00﻿", "x" * 7000, " " * 7000, "é" * 3500, "日本語 😀 ‍", "1234567890" * 400, "it's we'LL  I'd"]
    for text in [*texts.values(), *odd]:
        assert encode(text).tolist() == bpe.encode(text, add_special_tokens=False).ids


def check_packing(rows, table, bpe, size=packing.WINDOW):
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] and r["length"] > 0
    for s in sequences.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == np.cumsum([0, *(r["length"] for r in s)])[:-1].tolist()
        assert sum(r["length"] for r in s) <= size
    want = Counter()
    for r in table.select("doc_id", "text").collect():
        ids = np.array([*bpe.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want[(r["doc_id"], ids.tobytes())] += 1
    got = Counter()
    for key, found in by_doc.items():
        starts = defaultdict(list)
        for r in sorted(found, key=lambda r: r["start"]):
            starts[r["doc_tokens"]].append(r)
        for some in starts.values():
            copies = Counter(r["start"] for r in some)[0]
            raw = b"".join(r["ids"] for r in some) if copies == 1 else None
            if raw is not None:
                got[(key, raw)] += 1
            else:  # repeated rows may be cut at different places: count ids
                assert sum(r["length"] for r in some) == copies * some[0]["doc_tokens"]
                got.update({k: copies for k in want if k[0] == key and len(k[1]) == 4 * some[0]["doc_tokens"]})
    assert got == want
    return sequences


def test_packing_is_a_partition_of_all_ids(docs, bpe):
    rows = packing.pack(docs, BPE).collect()
    sequences = check_packing(rows, docs, bpe)
    short = [s for s in sequences.values() if sum(r["length"] for r in s) <= packing.WINDOW - packing.MIN_CUT]
    assert len(short) <= 1  # every other gap is below the cut


def test_packing_edges(edges, nothing, bpe):
    check_packing(packing.pack(edges, BPE).collect(), edges, bpe)
    check_packing(packing.pack(edges.filter("doc_id <> 4 OR doc_id IS NULL"), BPE, size=16, windows=2).collect(),
                  edges.filter("doc_id <> 4 OR doc_id IS NULL"), bpe, 16)
    assert packing.pack(nothing, BPE).count() == 0


def test_packing_merges_many_partitions(docs, bpe):
    many = docs.repartition(40, "doc_id")
    sequences = check_packing(packing.pack(many, BPE).collect(), many, bpe)
    filled = sum(r["length"] for s in sequences.values() for r in s)
    assert 1 - filled / (len(sequences) * packing.WINDOW) < 0.02


def test_best_fit_places_and_emits_the_fullest():
    packer = packing.Packer(0, 100, 2, False)
    piece = lambda i, n: (i, 0, n, np.arange(n, dtype=np.uint32))
    packer.place(piece(1, 60))
    packer.place(piece(2, 50))
    packer.place(piece(3, 40))  # fits both, best in the first, which is full now
    assert [(r[0], r[2]) for r in packer.take()] == [(1, 60), (3, 40)]
    packer.place(piece(4, 95))
    packer.place(piece(5, 70))  # fits none: the fullest goes out with its gap of 5, then a new window opens
    assert [(r[0], r[2]) for r in packer.take()] == [(4, 95)]
    assert [w[0] for w in packer.open] == [50, 30]


@pytest.mark.parametrize("count", [1, 2, 3, 10, 1000, 65_537])
def test_permutation(count):
    slots = shards.permuted(np.arange(count), count, 9)
    assert sorted(slots.tolist()) == list(range(count))
    if count > 100:
        assert not np.array_equal(slots, shards.permuted(np.arange(count), count, 10))
        assert abs(np.corrcoef(slots, np.arange(count))[0, 1]) < 0.1


def test_shards_round_trip_and_resume(spark, docs):
    target = new_path(spark, "shards")
    made = shards.write(docs.repartition(5, "doc_id"), BPE, target, stride=128, shard=500)
    rows = shards.read(spark, target).collect()
    assert sorted(r["slot"] for r in rows) == list(range(made["sequences"]))
    assert all(r["shard"] == r["slot"] // 500 and r["offset"] == r["slot"] % 500 * (128 * made["width"] + 1) for r in rows)
    want = shards.sequences(docs.repartition(5, "doc_id"), BPE, stride=128).select("ids").collect()
    assert Counter(bytes(r["ids"]) for r in rows) == Counter(bytes(r["ids"]) for r in want)
    some = {r["slot"]: bytes(r["ids"]) for r in shards.read(spark, target, 450, 1020).collect()}
    assert some == {r["slot"]: bytes(r["ids"]) for r in rows if 450 <= r["slot"] < 1020}
    again = new_path(spark, "shards")
    shards.write(docs.repartition(5, "doc_id"), BPE, again, stride=128, shard=500)
    assert {(r["slot"], bytes(r["ids"])) for r in shards.read(spark, again).collect()} == {(r["slot"], bytes(r["ids"])) for r in rows}


def test_shards_hold_every_document(spark, docs, bpe):
    made = shards.sequences(docs.repartition(3, "doc_id"), BPE, stride=64).collect()
    flat = defaultdict(list)
    for r in sorted(made, key=lambda r: (r["part"], r["number"])):
        flat[r["part"]].append(np.frombuffer(r["ids"], "<u2"))
    got = Counter()
    for parts in flat.values():
        ids = np.concatenate(parts)
        ends = np.flatnonzero(ids == 0)
        got.update(tuple(ids[a:b]) for a, b in zip(np.r_[0, ends[:-1] + 1], ends))
    want = Counter()
    for r in docs.select("text").collect():
        ids = bpe.encode(r["text"], add_special_tokens=False).ids
        cut = [i for i, x in enumerate(ids) if x == 0]
        assert not cut
        want[tuple(ids)] += 1
    got.pop((), None)  # the fill of the last sequences
    want.pop((), None)
    assert got == want


def test_shards_of_edges_and_nothing(spark, edges, nothing):
    target = new_path(spark, "shards")
    made = shards.write(edges, BPE, target)
    assert shards.checked(shards.read(spark, target)).count() == made["sequences"]
    empty = new_path(spark, "shards")
    assert shards.write(nothing, BPE, empty)["sequences"] == 0 and shards.read(spark, empty).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(MODEL)


def all_paths(lattice, unit):
    def walk(at):
        if at == lattice.end[unit]:
            yield (), 0.0
        else:
            for e in range(lattice.first[at], lattice.first[at + 1]):
                for rest, value in walk(at + lattice.length[e]):
                    yield (e, *rest), lattice.step[e] + value

    return list(walk(lattice.begin[unit]))


@pytest.mark.parametrize("head", [pieces.HEAD, 1])
def test_sampling_without_replacement(vocabulary, head, monkeypatch):
    monkeypatch.setattr(pieces, "HEAD", head)
    lattice = pieces.Lattice(["▁the", "▁on"], vocabulary)
    whole = {a + b: np.exp(x + y) for a, x in all_paths(lattice, 0) for b, y in all_paths(lattice, 1)}
    assert sum(whole.values()) == pytest.approx(1)
    n, k = 6000, 3
    first, pair, weight = Counter(), Counter(), Counter()
    for paths, threshold in pieces.sample([[0, 1]] * n, [pieces._row_key(i, 3) for i in range(n)], lattice, k):
        found = [tuple(p.edges.tolist()) for p in paths]
        assert len(set(found)) == k and paths[0].value >= paths[1].value >= paths[2].value >= threshold
        first[found[0]] += 1
        pair[found[0], found[1]] += 1
        for f, p in zip(found, paths):
            assert p.total == pytest.approx(np.log(whole[f]))
            weight[f] += whole[f] / -np.expm1(-np.exp(p.total - threshold)) / n
    likely = sorted(whole, key=whole.get)[-2:]
    for a in likely:
        assert first[a] / n == pytest.approx(whole[a], abs=4 * np.sqrt(whole[a] * (1 - whole[a]) / n) + 1e-3)
        assert weight[a] == pytest.approx(whole[a], abs=0.02)  # inclusion scores give unbiased weights
        for b in likely:
            if a != b:
                chance = whole[a] * whole[b] / (1 - whole[a])
                assert pair[a, b] / n == pytest.approx(chance, abs=4 * np.sqrt(chance / n) + 1e-3)


@pytest.mark.parametrize("head", [pieces.HEAD, 1])
def test_few_segmentations_are_all_found(vocabulary, head, monkeypatch):
    monkeypatch.setattr(pieces, "HEAD", head)
    lattice = pieces.Lattice(["▁to"], vocabulary)
    whole = dict(all_paths(lattice, 0))
    (paths, threshold), = pieces.sample([[0]], [pieces._row_key(1, 1)], lattice, len(whole) + 3)
    assert {tuple(p.edges.tolist()) for p in paths} == set(whole) and np.isneginf(threshold)


def test_segmentations_spell_the_text(spark, docs, edges, nothing, vocabulary):
    for table in (docs, edges):
        rows = pieces.encode(table, MODEL).collect()
        assert all(r["round_trip"] for r in rows)
        for r in rows[:200]:
            assert r["n_ids"] == len(r["ids"]) and 0 <= r["inclusion"] <= 1
        by_id = defaultdict(set)
        for r in rows:
            by_id[r["doc_id"], r["sample"]].add(tuple(r["ids"]))
        assert all(len(v) <= 2 for v in by_id.values())  # two texts stand under one id of the edges
    rows = pieces.encode(docs, MODEL).limit(30)
    want = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] == want[r["doc_id"]] for r in pieces.decode(rows, MODEL).collect())
    assert pieces.encode(nothing, MODEL).count() == 0


def test_samples_follow_the_row_not_the_batch(docs, vocabulary):
    some = docs.filter("doc_id < 60")
    key = lambda df: sorted(map(tuple, df.select("doc_id", "sample", "ids_crc32").collect()))
    assert key(pieces.encode(some, MODEL)) == key(pieces.encode(some.repartition(7, "doc_id"), MODEL))
    assert key(pieces.encode(some, MODEL)) != key(pieces.encode(some, MODEL, seed=2))


def test_the_library_decodes_the_ids(vocabulary):
    texts = ["Grüße, Welt!  Two  spaces", "日本語 😀\n\ttabs", " leading and trailing ", "x" * 300]
    for (key, rank, ids, *_rest), text in zip(pieces.segmentations([(i, t) for i, t in enumerate(texts)], vocabulary, 1, 5), texts):
        assert vocabulary.sp.decode(ids.tolist()) == text == vocabulary.decode(ids.tolist())


def test_kept_words_and_blocks_change_no_sample(texts, monkeypatch):
    """Any size of chunks, blocks and kept words gives the same ids and scores, in whichever order texts come."""
    rows = list(texts.items())[:150] + [(-1, None), (-2, ""), (-3, "x" * 3000), (-4, "a  b▁ c \x00 d")]

    def found(some, kept, chunk, block):
        monkeypatch.setattr(pieces, "KEPT", kept)
        monkeypatch.setattr(pieces, "CHUNK", chunk)
        monkeypatch.setattr(pieces, "BLOCK", block)
        return {(key, rank): (ids.tolist(), round(total, 6), round(value, 6), round(chance, 6))
                for key, rank, ids, total, value, chance, _ in pieces.segmentations(some, pieces.Vocabulary(MODEL), 2, 1)}

    want = found(rows, 0, 4_000_000, 1 << 16)
    assert len(want) >= 300
    assert found(rows, 500, 2_000, 100) == want and found(rows[::-1], 100_000, 5_000, 7) == want


def test_a_worker_goes_on_after_rows_left_unread(texts):
    v = pieces.Vocabulary(MODEL)
    rows = [(i, t) for i, t in texts.items() if t][:100]
    next(pieces.segmentations(rows, v, 2, 1))
    assert [r[2].tolist() for r in pieces.segmentations(rows, v, 2, 1)] == [r[2].tolist() for r in pieces.segmentations(rows, pieces.Vocabulary(MODEL), 2, 1)]


def test_words_seen_once_stay_where_there_is_room(monkeypatch):
    """The lattices of rare words serve the next chunks too, up to KEPT characters."""
    v = pieces.Vocabulary(MODEL)
    list(pieces.segmentations([(1, "each word once"), (2, "the the the")], v, 2, 1))
    assert v.words.number.units() == ["▁each", "▁word", "▁once", "▁the"]
    monkeypatch.setattr(pieces, "KEPT", 12)
    list(pieces.segmentations([(3, "the other one")], v, 2, 1))
    assert "▁the" in v.words.number.units() and len(v.words.lattice.codes) <= 12


def test_later_samples_draw_only_the_words_after_the_cut(texts, monkeypatch):
    drawn, plain = [], pieces.Lattice.drawn
    monkeypatch.setattr(pieces.Lattice, "drawn", lambda self, unit, key: drawn.append(len(unit)) or plain(self, unit, key))
    list(pieces.segmentations(list(texts.items())[:100], pieces.Vocabulary(MODEL), 2, 1))
    assert 0 < drawn[1] < drawn[0]


def test_spelling_is_decoding(texts, vocabulary):
    for _, _, ids, _, _, _, normal in pieces.segmentations(list(texts.items())[:100], vocabulary, 2, 1):
        assert vocabulary.spelling(ids) == normal.replace(pieces.SPACE, " ").encode() == b"".join(vocabulary.raw[i] for i in ids)


def test_ids_and_texts_come_from_one_worker(spark, docs, edges, tmp_path):
    """The query decodes where it segments: no second Python worker stands beside the first. Both ways give the same texts."""
    from lodestep.llm import queries

    table = docs.select("doc_id", "text").limit(40).unionByName(edges.select("doc_id", "text"))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.op8_sentencepiece(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    here = {(r["doc_id"], r["sample"], r["ids_crc32"], r["here"]) for r in pieces.encode(table, MODEL, with_ids=False, decoded="here").collect()}
    apart = pieces.decode(pieces.encode(table, MODEL), MODEL, out="there").collect()
    assert here == {(r["doc_id"], r["sample"], r["ids_crc32"], r["there"]) for r in apart} and len(here) > 40


def test_the_query_decodes_what_it_segments(spark, tmp_path):
    """Every sampled segmentation is decoded by the operator; the digest is that of the normalised text, without the space in front."""
    from lodestep.llm import queries

    texts = {1: "The cat sat on the mat", 2: "", 3: None, 4: "  caf\u00e9 \U0001f600\n two  blanks ", 5: "\u5b57" * 40}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    v = pieces.Vocabulary(queries.piece_file())
    found = queries.op8_sentencepiece(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == set(texts) and "ids" not in found[0].asDict()
    for r in found:
        want = v.normalized(texts[r["doc_id"]] or "").replace(pieces.SPACE, " ").encode()
        assert r["round_trip"] and r["decoded_sha256"] == hashlib.sha256(want[1:] if want[:1] == b" " else want).hexdigest()
    gaps = spark.createDataFrame([(1, None), (2, []), (3, [v.sp.piece_to_id("\u2581the")])], "k int, ids array<int>")
    assert [r["text"] for r in pieces.decode(gaps, queries.piece_file()).orderBy("k").collect()] == [None, "", "the"]
