import pytest

#: Columns that clash with names the operators use inside, or with their results.
EXTRA = "text_sha256 string, size long, key long, row string, kept boolean, words string, source_size long, digest string"


@pytest.fixture
def documents(spark):
    """A table of documents out of (doc_id, text, lang, source) tuples, with clashing extra columns."""

    def build(rows):
        full = [(*r, *("en", "s")[len(r) - 2 :], len(r[1] or ""), "x", 1, 2, "r", True, "w", 3, "d") for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return build


#: Documents with nulls, empty and blank texts, repeated rows, repeated ids, and one very long text.
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "a"),
    (4, "a"),
    (5, "one two three"),
    (6, "One  two\nthree"),
    (None, "no id here"),
    (None, None),
    (7, LONG),
    (8, LONG + " end"),
    (9, "naïve café x \U0001f600 ﬁ\n\n<p>&amp;\x00\\ end"),
    (9, "another text of one id"),
    (10, "a", None, None),
]
