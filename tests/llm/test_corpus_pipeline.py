"""The stages of the pipeline, each on what its predecessor kept."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import check
import corpus_pipeline
from lodestep.llm import queries, rules
from lodestep.llm.common import read, stored

from test_decisions import brute_spans, low
from test_repeats import brute_prints, connected


def test_stages_one_by_one(spark, sf):
    docs = read(spark, sf, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], sf), name))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [k.collect() for k in kept]
    verdicts = {r["doc_id"]: r["kept"] for r in rules.judge(docs, read(spark, sf, "labels")).collect()}
    assert {r["doc_id"] for r in rows[1]} == {i for i, ok in verdicts.items() if ok}
    last = {}
    for r in rows[1]:
        mark = hashlib.sha256(low(r["text"]).encode()).hexdigest()
        last[mark] = max(last.get(mark, -1), r["doc_id"])
    assert {r["doc_id"] for r in rows[2]} == set(last.values())
    prints = brute_prints(r["text"] for r in rows[2])
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    groups = defaultdict(list)
    for r, c in zip(rows[2], connected(len(prints), links)):
        groups[c].append(r["doc_id"])
    assert {r["doc_id"] for r in rows[3]} == {min(g) for g in groups.values()}
    before = {r["doc_id"]: r for r in rows[3]}
    assert {r["doc_id"] for r in rows[4]} == set(before)
    for r in rows[4]:
        assert r["n_chars"] == len(r["text"]) and not brute_spans(r["text"])
        if not brute_spans(before[r["doc_id"]]["text"]):
            assert r["text"] == before[r["doc_id"]]["text"]
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in rows[5]:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(before)
    for r in rows[4]:
        raw = b"".join(p["ids"] for p in sorted(pieces[r["doc_id"]], key=lambda p: p["start"]))
        assert np.frombuffer(raw, "<u4").tolist() == [*bpe.encode(r["text"], add_special_tokens=False).ids, 0]


def test_stages_on_edges_and_nothing(spark, sf, edges, nothing):
    for table in (edges, nothing):
        kept = [table]
        for name, stage in corpus_pipeline.STAGES:
            kept.append(stored(stage(spark, kept[-1], sf), name))
        ids = [Counter(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
        for before, after in zip(ids[:4], ids[1:5]):
            assert not after - before  # a stage adds no row
        # under 50 words, or mostly words that repeat: rejected; rows 4, 5 and the one without an id are one text, of which 5 stays
        assert set(ids[1]) <= {4, 5, 7, None} and set(ids[2]) <= {5, 7} | ({4} if 5 not in ids[1] else set())
        assert all(n == 1 for n in ids[2].values()) and ids[3] == ids[4] and set(ids[5]) == set(ids[4])
        assert kept[0].columns == kept[4].columns
    assert not any(ids)  # the empty table


def test_registered_queries(spark, sf):
    names = set(entry.queries())
    assert {f"op{i}_" for i in range(1, 14)} == {re.match(r"op\d+_", n)[0] for n in names if n.startswith("op")} and "pipeline" in names
    con = check.connect(sf)
    for name, sql in queries.SQL.items():
        assert check.compare(queries.QUERIES[name](spark, sf), con, sql) is None
