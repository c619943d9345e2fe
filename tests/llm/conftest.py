import pytest

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"

#: Odd rows that every operator on texts must take: null and empty texts, null ids, repeats, a very long text.
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000)) + "\n" + "tail " * 2000


@pytest.fixture
def odd_docs(spark):
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, "an orphan text without any id at all", "en", "b", 5),
        (None, None, None, "b", None),
        (4, LONG, "de", "b", 7),
        (5, "  \t\r\n \x0b\x0c ", "", "", 2),
        (6, "Ünïcödé ÉCOLE 漢字 \U0001f600 text", "fr", "a", 3),
    ]
    # extra columns with names the operators use themselves
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clash = ", ".join(f"{c} string" for c in ("id", "h", "h1", "fp", "row", "kind", "path", "key", "bucket", "part", "x", "weight"))
    return spark.createDataFrame([(*r, *["clash"] * 12) for r in rows], f"{schema}, {clash}")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
