import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd, n, vocab=4000):
    return " ".join(f"w{rnd.randrange(vocab)}" for _ in range(n))


def edge_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeats, clashes of ids."""
    rnd = random.Random(4)
    a, b = prose(rnd, 120), prose(rnd, 300)
    near = a.split()
    near[60] = "changed"
    long = prose(rnd, 20_000)
    rows = [(1, a), (2, a), (3, a.replace(" ", "  ")), (4, " ".join(near)), (5, a.upper()), (6, b), (6, b), (7, ""),
            (8, None), (9, " \n\t "), (10, "one"), (11, "one"), (12, "ONE two"), (None, b), (None, None), (13, long),
            (14, long + " tail"), (15, "ab" * 1000), (16, "the same line here\n" * 40), (17, b[:900] + a),
            (18, "é" * 500 + a), (19, " x y " * 100), (20, "|#$ " * 80), (21, b[600:1300]), (6, a + b)]
    lang = ["en", "de", None]
    return [(i, t, lang[k % 3], [None, "s1", "s0", "ü"][k % 4], None if k % 5 == 0 else len(t or "")) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with columns that clash with the names operators use."""
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in (
        "id", "n", "t", "s", "p", "d", "k", "kept", "size", "key", "hash", "raw", "word", "rng", "run", "copies", "component",
        "rep", "base", "found", "grp", "carry", "kind", "g", "x", "target", "words", "norm", "sha")}).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
