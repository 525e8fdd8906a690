import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, a column with a clashing name."""
    base = prose(1, 60)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper() + "\n\n", "en", None), (4, prose(2, 60), "fr", "b"), (4, prose(2, 60), "fr", "b"),
        (5, None, "de", "b"), (6, "", None, "b"), (7, " \n\t ", "en", ""), (8, "one two three", "en", "c"), (9, "ONE two\tthree", "es", "c"),
        (None, base, "en", "a"), (None, None, None, None), (10, prose(3, 4000), "en", "d"), (11, base + " tail1 tail2", "en", "a"), (12, "12 345 !!", "en", "d"),
        (13, "x" * 20000, "en", "d"),
    ]
    return spark.createDataFrame([(*r, "kept", 7) for r in rows], "doc_id long, text string, lang string, source string, n_lines string, size int")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
