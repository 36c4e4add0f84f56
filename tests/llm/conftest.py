import pytest

from tests.conftest import spark  # noqa: F401

SMALL = "/root/testdata/sf0.001"

# Names that the operators use inside: tables may have them too.
CLASHES = "id text_1 text_2 host part bucket place score lang_pred rejected n_letters doc print row_1 node turn tie base removed".split()


@pytest.fixture(scope="module")
def odd_docs(spark):  # noqa: F811
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    long = "\n".join(f"line {i} of a very long text with words {i * 7 % 97}" for i in range(4000))
    prose = "the first of many lines here\nand a second line that follows it\nand the third one to end it all"
    rows = [
        (None, None, None, None, None),
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, "a", 3),
        (4, long, "en", "b", len(long)),
        (5, prose, "en", "a", len(prose)),
        (5, prose, "en", "a", len(prose)),
        (6, prose, "fr", "a", len(prose)),
        (None, prose, "en", None, len(prose)),
        (7, "12 34 !! <|endoftext|> \x1c é🙂", "en", "a", 26),
        (8, "x" * 5000, "de", "b", 5000),
    ]
    rows = [(*r, *(["clash"] * len(CLASHES))) for r in rows]
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
    kinds = ["long", "string", "string", "string", "long", *["string"] * len(CLASHES)]
    return spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
