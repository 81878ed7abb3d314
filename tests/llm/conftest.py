import pytest

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def sentence(seed: int, n: int = 90) -> str:
    import random

    r = random.Random(seed)
    syllables = ["an", "er", "tion", "the", "ou", "re", "st", "li", "mo", "ka", "ven", "dor"]
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns with clashing names."""
    rows = [
        (1, sentence(1), "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (4, LONG, "en", None), (5, sentence(1), "fr", "b"), (5, sentence(1), "fr", "b"), (None, sentence(2), "en", "a"), (6, " \n\t ", "de", "c"),
        (7, "Wörter über Straßen", "de", "c"), (8, "one two", "en", "a"), (9, sentence(3) + "\n" + sentence(4), None, "c"), (9, sentence(5), None, "c"),
    ]
    rows = [(*r, "x", 1, "y", 2.5, "z", b"q") for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id string, size int, digest string, quality double, times string, _key binary")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
