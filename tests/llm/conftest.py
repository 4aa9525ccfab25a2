import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, id long, fingerprint string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Texts as a documents table with extra columns whose names operators use themselves."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 7, "y") for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, repeated rows, a very long text, words outside ASCII."""
    rng = random.Random(7)
    words = ["the", "of", "and", "été", "naïve", "Ünder", "x1", "9", "don't", "…", "a-b", "ﬁn", "İst", "²", "日本"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "\t", "  ", " ", "\x0b"]) for _ in range(n))
    base = [text(rng.randint(0, 120)) for _ in range(30)]
    return [None, "", " ", "\n\n", "one", *base, *base[:5], base[0], text(30_000), "w" * 70_000, None, "<|endoftext|> a <|startoftext|>b"]
