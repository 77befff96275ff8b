import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, n_tokens string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs, with columns whose names clash with
    those that operators make."""

    def make(rows, langs="en"):
        return spark.createDataFrame([(i, t, langs, f"s{(i or 0) % 2}", None if t is None else len(t), 0.5, "x", "y") for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, repeated, very long and unusual texts."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six"), (4, "one two three four five six"), (None, "one two three four five six"),
        (5, "word " * 60_000), (6, "\n" * 5_000 + "x" + " " * 5_000), (7, "日本語 العربية \U0001f600 e\u0301"), (8, "<|endoftext|> it's 'tis \x1c 12\u00a034"),
    ]
