import pytest

DOCS = "doc_id long, text string, lang string, source string, kept string, copies int, rank string"

#: Columns that clash with names of the operators.
EXTRA = ("x", 1, "y")

TEXT = (
    "The quick brown fox jumps over the lazy dog while seven wise owls look on from the old oak tree "
    "and count the stars that fall behind the quiet hill until the morning light returns"
)


def changed(text, place, word):
    words = text.split(" ")
    words[place] = word
    return " ".join(words)


def rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    found = [
        (1, TEXT, "en", "a"),
        (2, TEXT.replace(" ", "\n\t"), "en", "a"),
        (3, changed(TEXT, -1, "again"), "en", "b"),
        (4, "", "en", "b"),
        (5, None, None, None),
        (6, " \n ", "de", "a"),
        (None, TEXT, "en", None),
        (None, None, None, None),
        (7, "short text", "en", "c"),
        (8, "short text", "en", "c"),
        (9, "42 !!! 17", None, "c"),
        (10, " ".join(f"wort{i % 977}" for i in range(60_000)), "de", "a"),
        (11, "Ein ganz anderer Satz über die Straße und den schönen Garten hinter dem Haus", "de", "b"),
        (11, "Ein ganz anderer Satz über die Straße und den schönen Garten hinter dem Haus", "de", "b"),
        (12, "x" * 50_000, "en", "c"),
        (13, "naïve ﬁn 🙂   zero\u0000byte <|endoftext|> done", "fr", "a"),
    ]
    return [(*row, *EXTRA) for row in found]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def texts(spark):
    """A table of (doc_id, text, ...) from pairs."""

    def make(pairs, parts=4):
        found = [(i, text, "en", "a", *EXTRA) for i, text in pairs]
        return spark.createDataFrame(found, DOCS).repartition(parts)

    return make
