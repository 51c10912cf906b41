"""Small frames with every awkward case, shared by the operator tests."""

import pytest

CASES = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, a null id, a null source, repeated rows, one id with two texts, a very long
    text, and extra columns whose names operators use inside."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
    plain = "The quick brown fox jumps over the lazy dog near the river bank.\nIt runs home.\nThen it sleeps all day long."
    rows = [
        (1, plain, "en", "a", 10), (1, plain, "en", "a", 10), (2, "", "en", "a", 0), (3, None, "en", "b", None),
        (4, " \n\t ", None, None, 3), (None, plain, "en", "b", 10), (None, None, None, None, None), (5, plain + "\n", "en", "c", 11),
        (6, long, "de", "c", len(long)), (7, "twice", "en", "a", 5), (7, "two texts of one id", "en", "a", 5), (8, "Ünïcode ▁ mark \x00 é", "fr", "z", 9),
        (9, long, "de", "b", len(long)),
    ]
    df = spark.createDataFrame(rows, CASES)
    clashing = {name: "x" for name in ("kept", "rep", "size", "copies", "sha", "_text", "_id", "label", "n", "hash", "y", "start", "target", "_sha", "_size")}
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in clashing.items()})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], CASES)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
