import pytest

# A table that holds what may go wrong: nulls, empty, blank and repeated rows, a long text,
# marks outside ASCII, equal ids with other texts, and columns with the operators' own names.
AWKWARD = [
    (1, "The cat sat on the mat.\nThe cat sat on the mat.\n\n  \nA last line, of its own.", "en", "a"),
    (2, "The cat sat on the mat.\nThe cat sat on the mat.\n\n  \nA last line, of its own.", "en", "a"),
    (2, "The cat sat on the mat.\nThe cat sat on the mat.\n\n  \nA last line, of its own.", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \t\n\x0b ", "de", None),
    (None, "no id here, but words enough to make a shingle or two of them", "fr", "b"),
    (None, None, None, None),
    (7, "Ünïcödé ßtraße 日本語 👍🏽 é <|endoftext|>\x1cx y   z", "de", "b"),
    (7, "the same id again with another text, plain and short", "en", "b"),
    (8, "word " * 30_000, "en", "a"),
    (9, "x" * 50_000, "en", "a"),
    (10, "one", "en", "c"),
    (11, "ONE", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# Columns named like those that operators add.
EXTRA = ("node bigint", "kept string", "n_words int", "_doc string", "cell int", "length string",
         "component_id int", "bits int", "score int", "removed int", "`a b.c` int")


@pytest.fixture(scope="session")
def awkward(spark):
    rows = spark.createDataFrame(AWKWARD, SCHEMA)
    return rows.selectExpr("*", *(f"CAST(NULL AS {kind}) AS {name}" for name, kind in (
        e.rsplit(" ", 1) for e in EXTRA)))


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
