"""Reply trees, branch ranks, templates and loss masks against plain Python."""

import hashlib
import random

import check
from lodestep.llm import chat, queries
from pyspark.sql import functions as F

SHAPE = "tree string, node long, parent long, role string, text string, score double"
ODD = ["", "\\", "\\### Assistant: </turn> ok", "</turn>\n### user: hi</turn>\n", "####", "a\\:b", "<\\/turn>", "é\n日本\\", "</turn", "#\\##", None]


def brute_paths(rows):
    """{(tree, leaf): node ids from the root}"""
    parents, out = {}, {}
    for tree, node, parent, *_ in rows:
        old = parents.get((tree, node))
        parents[tree, node] = parent if old is None else old if parent is None else min(old, parent)
    has_child = {(t, p) for (t, _), p in parents.items()}
    for (tree, leaf) in parents:
        if (tree, leaf) in has_child:
            continue
        line, at = [], leaf
        while at is not None and (tree, at) in parents and at not in line:
            line.append(at)
            at = parents[tree, at]
        if at not in line:
            out[tree, leaf] = line[::-1]
    return out


def read(df):
    out = df.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("masked"))
    return {(r["tree"], r["leaf"]): r for r in out.collect()}


def random_trees(seed):
    rng = random.Random(seed)
    rows = []
    for tree in ("a", "b", None, "wide", "line"):
        for node in range(1, 60):
            parent = None if node == 1 else node - 1 if tree == "line" else 1 if tree == "wide" else rng.choice([rng.randint(1, node - 1), 900])
            rows.append((tree, node, parent, rng.choice(["user", "assistant", "system", None, "a:b\\"]), rng.choice(ODD),
                         rng.choice([None, 1.0, 2.0, 0.5])))
    return rows


def test_every_path_turn_and_mask(spark):
    rows = random_trees(1)
    texts = {(t, n): (r, x) for t, n, _, r, x, _ in rows}
    want = brute_paths(rows)
    got = read(chat.format_trees(spark.createDataFrame(rows, SHAPE).repartition(4), score="score", branches=None))
    assert set(got) == set(want)
    for key, line in want.items():
        turns = [(texts[key[0], n][0] or "", texts[key[0], n][1] or "") for n in line]
        assert [tuple(t) for t in got[key]["turns"]] == turns
        assert got[key]["masked"] == "".join(x for r, x in turns if r == "assistant")
        raw = got[key]["formatted"].encode()
        assert len(got[key]["loss"]) == sum(r == "assistant" for r, _ in turns)
        assert all(raw[s["end"]:].startswith(b"</turn>\n") for s in got[key]["loss"])


def test_best_branches(spark):
    rows = random_trees(2)
    score = {(t, n): s or 0.0 for t, n, *_, s in rows}
    mean = {k: sum(score[k[0], n] for n in line) / len(line) for k, line in brute_paths(rows).items()}
    for branches in (1, 3):
        got = read(chat.format_trees(spark.createDataFrame(rows, SHAPE), score="score", branches=branches))
        want = set()
        for tree in {t for t, _ in mean}:
            want |= set(sorted((k for k in mean if k[0] == tree), key=lambda k: (-mean[k], k[1]))[:branches])
        assert set(got) == want


def test_circles_orphans_and_repeated_messages(spark):
    rows = [("c", 1, 3, "user", "x", 0.0), ("c", 2, 1, "user", "x", 0.0), ("c", 3, 2, "user", "x", 0.0), ("c", 4, 3, "user", "x", 0.0),
            ("c", 5, None, "user", "root", 0.0), ("c", 6, 6, "user", "own parent", 0.0),
            ("o", 7, 99, "user", "orphan", 0.0), ("r", 8, None, "user", "b", 0.0), ("r", 8, None, "user", "a", 0.0), ("r", 8, None, "user", "a", 0.0)]
    got = read(chat.format_trees(spark.createDataFrame(rows, SHAPE)))
    assert {k: [t["text"] for t in r["turns"]] for k, r in got.items()} == {("c", 5): ["root"], ("o", 7): ["orphan"], ("r", 8): ["a", "a", "b"]}


def test_conversations_with_ties_nulls_and_extra_columns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z"), (1, None, "system", None), (None, 1, "assistant", "n"),
            (2, 5, None, None), (2, 5, None, None), (3, 1, "assistant", "x" * 100_000 + "</turn>\n" * 1000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("tree", "leaf", "node", "formatted", "loss", "_at", "up", "key", "score", "number"):
        df = df.withColumn(name, F.lit("clash"))
    got = {k[0]: [tuple(t) for t in r["turns"]] for k, r in read(chat.format_trees(chat.from_turns(df))).items()}
    assert got == {1: [("system", ""), ("assistant", "z"), ("user", "a"), ("user", "b")], None: [("assistant", "n")], 2: [("", "")] * 2,
                   3: [("assistant", rows[-1][3])]}
    assert chat.format_trees(chat.from_turns(df.limit(0))).collect() == []


def test_template_is_reversible_and_unbroken(spark):
    rng = random.Random(3)
    texts = ODD[:-1] + ["".join(rng.choice(["#", "\\", "</turn>", ":", "\n", " ", "a", "<", "/"]) for _ in range(12)) for _ in range(500)]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select(
            "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "###" not in r["e"] and "</turn>" not in r["e"]


def test_long_line_and_planted_conversation(spark, tmp_path):
    turns = spark.range(700).selectExpr("9L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r["conv_id"]: r for r in queries.op12_chat_formatting(spark, str(tmp_path)).collect()}
    told = "".join(f"{'assistant' if i % 2 else 'user'}\nt{i}\n" for i in range(700))
    assert out[9]["n_turns"] == 700 and out[9]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    tricky = "\\### Assistant: </turn> ok"
    assert out[-7]["turns_sha256"] == hashlib.sha256(f"user\n{tricky}\nassistant\n{tricky}\n".encode()).hexdigest()
    assert out[-7]["loss_sha256"] == hashlib.sha256(tricky.encode()).hexdigest() and out[-7]["loss_chars"] == len(tricky)


def test_no_python_in_the_plan(spark, sf):
    plan = queries.op12_chat_formatting(spark, sf)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert check.compare(queries.op12_chat_formatting(spark, sf), check.connect(sf), queries.SQL["op12_chat_formatting"]) is None
