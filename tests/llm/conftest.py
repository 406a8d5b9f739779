import pytest

#: Rows that every operator must take: nulls, empty, white space, ties, repeats, a very long text.
ODD = [
    (1, "the cat sat on the mat", "en", "a", 22),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n\x0b\x0c\r ", "en", "a", 7),
    (5, "the cat sat  on the mat\n", "en", "b", 24),
    (5, "the cat sat  on the mat\n", "en", "b", 24),
    (None, "a text without an id, mail x.y@example.com now", "en", "b", 46),
    (7, "word " * 40_000, "en", "c", 200_000),
    (8, "é" * 30_000, "fr", "c", 30_000),
    (9, "Straße 日本語 🙂 +1 (555) 123-4567 and 10.0.0.1", "de", "c", 45),
    (-4, "the cat sat on the mat", "en", "a", 22),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside themselves.
CLASH = (
    "digest", "best", "kept", "slot", "part", "bits", "doc", "place", "stop", "ranges", "key", "base", "terms",
    "_id", "_crc", "_base", "length", "rank", "slice", "sequence_id", "probability", "ids", "edits", "t",
)


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def odd_clashing(spark, odd):
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit("other") for c in CLASH})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def text_of(documents):
    return dict(documents.select("doc_id", "text").collect())
