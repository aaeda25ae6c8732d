import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or (text, lang, source) rows; ids count up."""

    def make(rows, extra=()):
        out = []
        for i, r in enumerate(rows):
            text, lang, source = r if isinstance(r, tuple) else (r, None, "s")
            out.append((i, text, lang, source, None if text is None else len(text), *[f"x{i}" for _ in extra]))
        return spark.createDataFrame(out, ", ".join([DOCS, *[f"`{c}` string" for c in extra]]))

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, short, tied and very long texts."""
    return [None, "", " \n\t ", "one", "a b c d e", "a b c d e", "x " * 30_000, "y" * 50_000, "Grüße 😀 café non-break"]
