import pytest

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA}/sf0.01"


TEXTS = [
    None, "", " ", "word", "a b c", "A  b\tc", "same text here", "same text here", "same  text here", "é \U0001F600 ß", "x" * 5000, "w " * 3000,
    "password=abcdef12 user=bob https://host.example/x AKIA" + "B" * 16, "mail a@b.co 1.2.3.4 +49 30 1234567", "MIT License. mit license", "<|endoftext|> İ ς Σ don't they'll a.b,c!! 12",
]


@pytest.fixture
def odd(spark):
    """Documents with null, empty, long and repeated texts, repeated and null ids, clashing columns."""
    rows = [(i, t, "en" if i % 3 else None, "s", 1, 0, "k", 5) for i, t in enumerate(TEXTS)]
    rows += [(7, TEXTS[7], "en", "s", 2, 1, "k", 6), (None, "same text here", "de", "s", 3, 2, "k", 7), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long, kind string, `end` long")


@pytest.fixture
def none(odd):
    return odd.limit(0)
