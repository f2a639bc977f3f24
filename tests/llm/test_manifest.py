"""Merkle trees, proofs and their folding against a plain recomputation."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from lodestep.llm import manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def path(tree, at, arity):
    steps = []
    for level in tree[:-1]:
        first = at - at % arity
        steps.append(("".join(level[first:at]), "".join(level[at + 1:first + arity])))
        at //= arity
    return steps


def brute(rows, arity=2):
    groups = defaultdict(list)
    for r in rows:
        r = r.asDict()
        r["leaf"] = plain_leaf(r)
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        n = r["n_chars"]
        r["changed"] = plain_leaf({**r, "n_chars": n if n is None else n + 1}) if hit else r["leaf"]
        groups[b"" if r["lang"] is None else b"=" + r["lang"].encode()].append(r)
    trees = {}
    for g, members in groups.items():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
        trees[g] = levels([r["leaf"] for r in members], arity)
    order = sorted(trees)
    top = levels([trees[g][-1][0] for g in order], arity) if trees else []
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            steps = path(trees[g], at, arity) + path(top, k, arity)
            value = r["changed"]
            for left, right in steps:
                value = digest(left, value, right)
            out.append((r["doc_id"], r["leaf"], trees[g][-1][0], top[-1][0], digest(*[a + b for a, b in steps]), value, value == top[-1][0]))
    return sorted(out, key=str)


def got(df, arity=2):
    return sorted((tuple(r) for r in manifest.check(df, arity=arity).collect()), key=str)


@pytest.mark.parametrize("arity, depth", [(2, 8), (2, 2), (3, 1), (5, 2)])
def test_equal_to_plain_trees(docs, monkeypatch, arity, depth):
    monkeypatch.setattr(manifest, "LEVELS", depth)  # small blocks give several layers
    assert got(docs, arity) == brute(docs.collect(), arity)


def test_groups_of_many_sizes(spark, monkeypatch):
    rows = [(i, f"t{i}", f"g{n}", "s", i) for n in (1, 2, 3, 4, 5, 255, 256, 257, 700) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert got(df) == brute(df.collect())
    monkeypatch.setattr(manifest, "LEVELS", 1)
    assert got(df) == brute(df.collect())


def test_edges_and_nothing(edges, nothing):
    nulls = edges.selectExpr("doc_id", "text", "nullif(lang, 'en') as lang", "if(doc_id % 2 = 0, 'é', null) as source", "nullif(n_chars, 0) as n_chars")
    for df in (edges, nulls, edges.unionByName(edges), edges.limit(1)):
        assert got(df) == brute(df.collect())
    assert got(nothing) == []


def test_rows_that_all_share_a_key(spark):
    df = spark.range(3000).selectExpr("5L as doc_id", "'same' as text", "'en' as lang", "'s' as source", "4L as n_chars")
    assert got(df) == brute(df.collect())


def test_general_interface(spark):
    x, y, z = digest("x"), digest("y"), digest("z")
    df = spark.createDataFrame([(1, "a", x), (2, "a", y), (3, "b", z)], "k int, g string, leaf string")
    out = {r["k"]: r for r in manifest.prove(df, "leaf", "g", "k", carry=["g"]).drop("g").collect()}
    assert out[3]["subroot"] == z and [tuple(s) for s in out[3]["path"]] == [(digest(x, y), "")]
    assert out[1]["root"] == digest(digest(x, y), z) and [tuple(s) for s in out[1]["path"]] == [("", y), ("", z)]
