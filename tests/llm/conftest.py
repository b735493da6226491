import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, id string, fp string, seed string, hash string, "
          "block string, length string, score string, kept string, part string")


def prose(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, odd white space and code points."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    passage = prose(rng, 80, words)
    texts = ["", None, " ", "\n\n", "one", "two words", "The the THE the the the the the", " a  b", "x \n\ty  z ", "a\n \tb ,'s don't", "é ΣΑΣ 12 ３ ́x",
             "a\x1cb \x1c c\x85d \xa0 e", "<|endoftext|> hi", prose(rng, 9, words), prose(rng, 400, words), prose(rng, 40_000, words), "die " * 5000, "x" * 5000,
             "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") + (" " if i % 40 == 39 else "") for i in range(6000))]
    texts += [prose(rng, 30, words) + " " + passage + " " + prose(rng, rng.randint(1, 60), words) for _ in range(5)]
    texts += [prose(rng, 25, words) + " " + passage[:210]]
    near = prose(rng, 300, words)
    texts += [near, near, near + " end", "other " + near, near.upper()]
    texts += [prose(rng, rng.randint(1, 200), words) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[14], rows[14], (None, "no id " + near), (None, None), (15, "another text for an id")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows as documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en" if i is None or i % 3 else "xx", "src", len(t or ""), *"kifshblska") for i, t in odd_rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
