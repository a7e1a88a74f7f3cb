import random

import pytest

LONG = " ".join(f"word{i % 977}" for i in range(20_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty and very long texts, repeated rows and ids, clashing extra columns."""
    rows = [
        (1, "plain words, here and there", "en", "a", 7),
        (1, "plain words, here and there", "en", "a", 7),
        (1, "other words under the same id", "en", "b", 7),
        (2, None, "en", None, 1),
        (3, "", None, "a", None),
        (4, " \n\t ", "de", "", 3),
        (None, "a text without an id", "fr", "c", 2),
        (None, None, None, None, None),
        (5, LONG, "en", "a", 1),
        (6, "x" * 60_000, "en", "b", 1),
        (7, "tab\tand\u3000wide space e\u0301 <|endoftext|> it's A.B,c 3.5!! ½", "en", "c", 1),
        (-8, "1234 5678 ... !!!", "en", "c", 1),
    ]
    rows = [(*row, i, i % 3, f"k{i}", float(i)) for i, row in enumerate(rows)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    # Names that the operators use for themselves.
    return spark.createDataFrame(rows, f"{names}, size int, part int, `_key` string, target double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id = 12345")


@pytest.fixture(scope="session")
def prose():
    """A maker of invented documents and of near copies of them."""
    rng = random.Random(5)

    def document(size):
        return [f"w{rng.randrange(400)}" for _ in range(size)]

    def near(words, changes):
        copy = list(words)
        for _ in range(changes):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10_000)}"
        return copy

    return document, near
