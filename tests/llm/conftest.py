import pytest

#: Ids and texts with a null in either, empty and blank texts, repeated rows, ties, and one very long text.
AWKWARD = [
    (1, "one two three four five six seven"),
    (1, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (None, "one two three four five six seven"),
    (3, None),
    (None, None),
    (4, ""),
    (5, " \n\t\n "),
    (6, "Ünï çödé — “quotes” 你好 🙂"),
    (7, "123 456 !!! ###"),
    (8, "long " * 60_000 + "end"),
    (9, "tail\n" * 300),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows above, with further columns under the names that operators give their results."""
    rows = [(*r, "x", 1.5, None, True) for r in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, kept string, score double, row string, hits boolean"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def docs_of(spark):
    def build(texts, **columns):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)

    return build
