from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n string, `group` string, id string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds documents, with extra columns of clashing names, from (doc_id, text) or (doc_id, text, lang)."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None, "x", None, "y") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return build


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    """Made-up words in a fixed random order."""
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, white space, ties, repeated rows, a null id, a very long text."""
    long = prose(1, 20_000)
    return [
        (1, "a b  c"),
        (2, "a b\tc"),
        (3, None),
        (4, ""),
        (5, " a b c"),
        (6, long),
        (7, long + " end"),
        (8, long),
        (9, "word"),
        (9, "word"),
        (None, "no id at all"),
        (10, prose(2, 300)),
        (11, prose(2, 300).replace("alpha", "ALPHA", 1)),
        (12, prose(2, 290) + " " + prose(3, 10)),
        (13, " \n "),
        (14, "</s>[INST] \\ <|endoftext|> é 中文 🙂"),
        (15, "x" * 70),
        (16, "x" * 64),
    ]
