import random

import pytest

WORDS = "the of and to in is that it was for on are as with his they at be this have from or one had by word but not what all were".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 300)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeats, and columns whose names the operators use themselves."""
    long = prose(1, 30_000) + "\n" + "x" * 50_000
    rows = [
        (1, prose(2, 60), "a"), (2, prose(2, 60), "b"), (2, prose(2, 60), "b"), (3, "", "a"), (4, None, None), (None, prose(2, 60), "a"), (None, None, "c"),
        (5, "  \n\t ", "a"), (6, long, "a"), (7, "one", "b"), (8, "ONE", "c"), (9, "é ü " * 40, "a"), (10, "\n\n\n", "d"), (11, prose(11, 60) + " 4111 1111 1111 1111", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("component_id", "kept", "n", "comp", "__gone", "n_removed", "pos", "score", "stats", "b", "cid", "m", "token", "sequence_id", "fp1", "__d", "h0", "start"):
        df = df.selectExpr("*", f"'z' as `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
