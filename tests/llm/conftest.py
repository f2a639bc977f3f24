import random

import pytest

from lodestep.llm.common import prepare, read

#: Columns whose names the operators use inside.
CLASHING = ("digest", "row", "kept", "raw", "spans", "fp", "mark", "part", "score", "n_words", "_kept_id", "id", "key", "text_sha256")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return read(prepare(spark), sf, "documents")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def edges(spark):
    """Null ids and texts, empty and blank texts, ties, repeated rows, one id with two texts, a long text, extra columns."""
    prepare(spark)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(40_000))
    prose = " ".join(rng.choice(words) for _ in range(120))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, prose), (4, prose), (5, prose.upper()), (None, prose), (6, "a"), (7, long), (8, "x" * 5000),
            (9, prose + "\n" + prose), (10, "line one\n" * 30), (11, "naïve Äß " * 40), (11, "another text under the same id"), (None, None)]
    shape = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *["x"] * len(CLASHING)) for i, t in rows], shape).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark, edges):
    return spark.createDataFrame([], edges.schema)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (7, None), (10, 0)], "doc_id long, quality int")
