import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng: random.Random, n: int, words=WORDS) -> str:
    out = []
    for k in range(n):
        w = rng.choice(words)
        out.append(w.capitalize() if k % 9 == 0 else w + ("." if k % 9 == 8 else ""))
    return " ".join(out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_from(texts, first=0):
    return [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]


def odd_rows():
    """Nulls in every column, empty, blank and wordless texts, a very long one, repeated rows."""
    rng = random.Random(3)
    long = prose(rng, 60_000)
    same = prose(rng, 80)
    return [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "a", 4),
        (None, prose(rng, 50), "de", None, None),
        (None, None, None, None, None),
        (4, "!!! ... ???", "en", "b", 11),
        (5, long, "en", "b", len(long)),
        (6, same, "en", "b", len(same)),
        (6, same, "en", "b", len(same)),
        (7, same, "en", "c", len(same)),
        (8, "x", "fr", "c", 1),
        (9, "one two", "fr", "c", 7),
        (10, "Ünïcödé \U0001f600 naïve", "fr", "c", 16),
    ]


@pytest.fixture()
def odd(spark):
    """The rows above with further columns whose names clash with what the operators add."""
    base = spark.createDataFrame(odd_rows(), SCHEMA)
    return base.selectExpr("*", "'kept' AS kept", "1 AS n", "'k' AS k", "'x' AS component", "7 AS score", "'s' AS spans", "0 AS piece", "'w' AS `a.b`")


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
