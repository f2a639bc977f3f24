"""Near words, forms and roots against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from lodestep.llm import spelling
from lodestep.llm.common import prepare

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOW = {c: c + 32 for c in range(65, 91)}


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_variants(words):
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for a in words:
        near[a] = [b for k in (len(a) - 1, len(a), len(a) + 1) for b in by_length.get(k, []) if one_apart(a, b)]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o.encode()), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def noisy(spark):
    """Texts of a few roots with one and two edits, accents, long words and doubled letters."""
    prepare(spark)
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzéüßÿÀ×"
    roots = ["".join(rng.choice(letters) for _ in range(n)) for n in (7, 7, 8, 9, 9, 12, 63, 64, 65, 66, 140)] + ["aaaaaaaa", "zzzzzzz"]

    def edited(w):
        i, c = rng.randrange(len(w)), rng.choice(letters)
        return rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])

    rows = []
    for k in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(roots)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                w = edited(w)
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((k, rng.choice([" ", ", ", "\n", "1"]).join(words)))
    return rows


def test_equal_to_all_pairs(spark, noisy):
    df = spark.createDataFrame(noisy, "doc_id long, text string").repartition(6)
    words = brute_words(noisy)
    want = brute_variants(words)
    assert got(spelling.variants(df)) == want
    assert any(r[1] and r[1] != r[2] for r in want) or any(r[1] for r in want)


def test_many_rounds_lose_nothing(spark, noisy):
    words = brute_words(noisy)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    want = sorted((a, words[a], b, words[b]) for a in words for b in words if one_apart(a, b))
    for part_blocks, limit in ((1 << 18, 1 << 25), (3, 24), (1, 1)):
        assert sorted(map(tuple, spelling.near_words(df, part_blocks, limit).collect())) == want


def test_chains_reach_their_root(spark):
    chain = ["abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    text = " 1 ".join(" ".join([w] * n) for w, n in zip(chain, (2, 20, 200, 2000)))
    rows = [(k, text) for k in (3, 3)]
    out = got(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out == brute_variants(brute_words(rows))
    assert len({r[2] for r in out}) < len(out)


def test_long_texts_are_read_in_stretches(monkeypatch):
    rng = random.Random(8)
    text = " ".join("".join(rng.choice("abcdeÉ") for _ in range(rng.randint(1, 30))) for _ in range(500))
    whole = spelling._runs(text)
    monkeypatch.setattr(spelling, "STRETCH", 17)
    assert spelling._runs(text) == whole == Counter(w.translate(LOW) for w in RUNS.findall(text) if len(w) >= 7)


def test_edges_and_nothing(edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    assert got(spelling.variants(edges)) == brute_variants(brute_words(rows))
    twice = edges.unionByName(edges)
    assert got(spelling.variants(twice)) == brute_variants(brute_words(rows * 2))
    assert got(spelling.variants(nothing)) == []
